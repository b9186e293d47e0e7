"""Tests of the pipeline operators."""
