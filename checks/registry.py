"""Loads all query modules."""

from checks import associate, clean, columns, divide, encode, prepare, statistics  # noqa: F401
from checks.base import ORACLE, QUERIES  # noqa: F401
