"""Bytes of a page -> text: which charset it is in, and decoding (S-6).

The order is that of browsers: a byte order mark, the charset that the server
named, a ``meta`` tag among the first 1,024 bytes, else UTF-8 if the bytes are
valid UTF-8, else Windows-1252. Bytes that a charset does not know become
U+FFFD; no page fails.
"""

from __future__ import annotations

import codecs
import re

# fixed values of the web's encoding rules
BOMS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
LATIN = frozenset("iso-8859-1 iso8859-1 latin1 latin-1 l1 ascii us-ascii windows-1252 cp1252".split())  # all mean Windows-1252
META_BYTES = 1024
META = re.compile(rb"""<meta\b[^>]*?\bcharset\s*=\s*["']?\s*([A-Za-z0-9_.:-]+)""", re.I)
HEADER = re.compile(r"""charset\s*=\s*["']?\s*([A-Za-z0-9_.:-]+)""", re.I)


def known(label: str | None) -> str | None:
    """The codec's name for a charset label; None if there is none."""
    label = (label or "").strip().strip("\"'").lower()
    if not label:
        return None
    if label in LATIN:
        return "cp1252"
    try:
        name = codecs.lookup(label).name
        "".encode(name)  # a text encoding?
    except (LookupError, ValueError, TypeError):
        return None
    return "utf-16-le" if name == "utf-16" else name


def detect(content: bytes, header: str | None = None) -> tuple[str, int]:
    """(codec, bytes to skip) for a page; ``header`` is a charset label or a
    Content-Type value."""
    for bom, name in BOMS:
        if content.startswith(bom):
            return name, len(bom)
    if header:
        m = HEADER.search(header)
        name = known(m[1] if m else header if "/" not in header else None)
        if name:
            return name, 0
    m = META.search(content[:META_BYTES])
    name = known(m[1].decode("ascii")) if m else None
    if name:  # a meta tag that could be read is not in UTF-16
        return "utf-8" if name.startswith("utf-16") else name, 0
    try:
        content.decode("utf-8")
        return "utf-8", 0
    except UnicodeDecodeError:
        return "cp1252", 0


def decode_page(content: bytes | None, header: str | None = None) -> tuple[str | None, str | None]:
    """(text, codec) of a page; null bytes give null."""
    if content is None:
        return None, None
    name, skip = detect(content, header)
    return content[skip:].decode(name, "replace"), name
