"""Tests of the operators over documents and pages."""
