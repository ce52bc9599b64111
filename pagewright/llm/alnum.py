"""Alphanumeric words: ASCII letters and digits and all other characters beyond ASCII, A-Z lower-cased."""
from __future__ import annotations

# The same rule as a pattern over lower-cased text: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
# Newlines stay, so that a text can be cut into lines before its words are split.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 or b == 10 else 32
              for b in range(256))


def plain(text: str | None) -> bytes:
    """UTF-8 bytes in which words are all that is neither a blank nor a newline; null is empty."""
    return (text or "").encode().translate(PLAIN)


def words(text: str | None) -> list[bytes]:
    return plain(text).split()
