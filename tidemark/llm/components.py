"""Connected components, as the text operators use them."""

from ..operators.components import components

__all__ = ["components"]
