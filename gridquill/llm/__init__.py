"""Operators that prepare a training corpus. Nothing else in gridquill imports this subpackage."""
