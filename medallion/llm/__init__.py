"""Operators for preparing training data: text, chat, web archives, vectors."""
