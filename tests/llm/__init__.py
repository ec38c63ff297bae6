"""Tests of the llm operators."""
