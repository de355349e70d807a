"""Plain forms of what the operators read."""

import re


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})
