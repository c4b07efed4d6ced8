"""Operators for training data: each module holds one operator, ``registry`` their queries."""
