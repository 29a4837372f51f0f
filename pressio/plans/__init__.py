"""Composed plans: the full result (P1) and its published shapes."""

from . import products, result

__all__ = ["products", "result"]
