"""Pre-token patterns for texts of plain characters.

``SAFE`` texts hold ASCII, Latin letters with marks and common punctuation:
characters whose class, case and composition are alike in every version of
Unicode.  Patterns with ``\\p{L}`` and ``\\p{N}`` are spelled out for them; other
texts go to the tokenizer library itself.
"""

from __future__ import annotations

import re
import unicodedata

_RANGES = ((0x09, 0x0A), (0x0D, 0x0D), (0x20, 0x7E), (0xA1, 0xAC), (0xAE, 0x12F), (0x132, 0x148), (0x14A, 0x17E), (0x2013, 0x2026), (0x20AC, 0x20AC))
_CHARS = [chr(c) for a, b in _RANGES for c in range(a, b + 1)]
SAFE = re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in _RANGES) + "]*")


def _kind(letter: str) -> str:
    return "".join(re.escape(c) for c in _CHARS if unicodedata.category(c)[0] == letter)


def plain_pattern(pattern: str) -> re.Pattern:
    """A pattern for safe texts; blanks among them are tab, line feed, carriage return and space."""
    p = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^\t\n\r {_kind('L')}{_kind('N')}]").replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}")
    return re.compile(p.replace(r"\p{L}", f"[{_kind('L')}]").replace(r"\p{N}", f"[{_kind('N')}]"))
