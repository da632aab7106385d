"""Operators for preparing training text: tokens, secrets, personal data, copies, quality."""
