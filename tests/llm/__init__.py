"""Tests of the operators over documents."""
