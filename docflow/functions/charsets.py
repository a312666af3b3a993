"""Bytes of pages to text, whatever their character set."""

from __future__ import annotations

import codecs
import re

#: Bytes at the beginning of a page in which its character set is declared.
DECLARED_WITHIN = 1024

_MARKS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
_DECLARED = re.compile(rb"""<(?:meta[^>]*?charset|\?xml[^>]*?encoding)\s*=\s*["']?\s*([\w.:-]+)""", re.IGNORECASE)
# What browsers take these for.
_TAKEN_FOR = {"ascii": "cp1252", "iso8859-1": "cp1252", "utf-16": "utf-8", "utf-16-le": "utf-8", "utf-16-be": "utf-8", "iso8859-9": "cp1254", "gb2312": "gb18030", "gbk": "gb18030", "shift_jis": "cp932", "euc_kr": "cp949"}
# Codecs that are no character sets of pages.
_NO_SETS = {"unicode_escape", "raw_unicode_escape", "idna", "punycode", "utf_7", "undefined"}


def declared_charset(data: bytes) -> str | None:
    """The codec of the character set that a page declares, if there is one of this name."""
    found = _DECLARED.search(data[:DECLARED_WITHIN])
    if not found:
        return None
    try:
        name = codecs.lookup(found[1].decode("ascii")).name
        name = _TAKEN_FOR.get(name, name)
        b" ".decode(name)
    except (LookupError, UnicodeError):
        return None
    return None if name.replace("-", "_") in _NO_SETS else name


def decoded(data: bytes) -> str:
    """A page's text: by its byte-order mark, else by its declared set, else by its bytes.

    Bytes that are UTF-8 are taken as such where nothing is declared, others as
    Windows-1252. What a set has no character for becomes U+FFFD.
    """
    for mark, name in _MARKS:
        if data.startswith(mark):
            return data[len(mark) :].decode(name, "replace")
    name = declared_charset(data)
    if name is not None:
        return data.decode(name, "replace")
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("cp1252", "replace")
