"""Operators that prepare text for training language models. Nothing outside this folder imports it."""
