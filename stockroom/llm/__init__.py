"""Operators of a training-data pipeline over documents and conversations; nothing else imports this package."""
