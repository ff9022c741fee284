"""Operators of a training-data pipeline over documents, pages and chats.

Nothing else in the library imports this subpackage.
"""
