"""Resumable and continuous forms of the batch jobs."""
