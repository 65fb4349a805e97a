"""Readers of tables, messages, predictions and models."""
