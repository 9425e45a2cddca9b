"""Readers, writers and the tokenizer store."""
