"""Runnable jobs that chain the operators."""
