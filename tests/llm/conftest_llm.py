"""Helpers of these tests."""

import re


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)
