"""Operators for preparing training text and searching vectors. Nothing else imports this package."""
