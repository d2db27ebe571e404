"""Scalar building blocks as Column expressions."""

from tidewater.functions.scalar import *  # noqa: F401,F403
