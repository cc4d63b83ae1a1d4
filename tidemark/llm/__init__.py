"""Operators over text corpora for training data; nothing else imports them."""
