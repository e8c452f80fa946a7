"""Operators for preparing training text: near copies, personal data, toxicity, contamination, token counts,
quality, chat templates, mixing and archives.  Nothing else in the library imports this subpackage."""
