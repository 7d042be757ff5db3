"""Composite jobs: the normal run, the batch migration and the read-back."""
