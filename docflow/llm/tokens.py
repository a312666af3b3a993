"""Token ids of whole texts by a public tokenizer, a batch of documents at a time.

A batch of texts is one array of characters. It is cut into what the tokenizer's pattern
would cut it into, and each distinct part is looked up once among those whose ids are
kept; only parts that are not kept reach the tokenizer's model. Nothing is done in Python
per word of a text. Characters beyond Latin-1 have classes and normal forms that depend on
tables of Unicode: pieces with them, as cut at white space where that cannot change their
ids, and texts that cannot be cut there or that may hold a token added to the vocabulary
go through the whole tokenizer.
"""

from __future__ import annotations

import re
import sys
from array import array
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

#: Bytes of text to encode at a time: each takes about 12 bytes of memory meanwhile.
SLICE = 1 << 21
#: Parts whose ids a worker keeps, about 30 bytes each, pieces beyond Latin-1, about 130,
#: and the characters of one. Others are encoded anew: this bounds memory only.
MOST_KEPT = 300_000
RARE_KEPT = 200_000
LONGEST_KEPT = 64
#: A blank next to white space: cutting there could move white space between tokens.
_UNSAFE = re.compile(r" (?:(?=\s)|(?<=\s ))")
#: White space to Python, but not to the tokenizers.
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Classes of the characters of Latin-1 in the tokenizers' patterns.
_SPACE, _LETTER, _NUMBER, _OTHER, _NONE = range(5)
_LATIN = [chr(c) for c in range(256)]
_CLASS = np.array([next((k for k, p in enumerate((r"\s", r"\p{L}", r"\p{N}")) if regex.match(p, c)), _OTHER) for c in _LATIN], np.uint8)
_SPACES = bytes(np.flatnonzero(_CLASS == _SPACE).tolist())


def _byte_characters() -> list[str]:
    """The characters that stand for bytes: visible ones themselves, others from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


def _bytes(ids: list[int]) -> bytes:
    packed = array("H", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def cut(data: np.ndarray, bounds: np.ndarray, blanks_count: bool) -> np.ndarray:
    """Where the parts of texts begin, in ascending order; each ends where the next begins.

    ``data`` has the Latin-1 characters of all texts, ``bounds`` where each begins. Parts
    are those of the tokenizers' patterns, which are fixed values:
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``, or, if
    blanks do not count, ``'s|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+``, with
    the white space that follows.
    """
    n = len(data)
    kind = np.full(n + 3, _NONE, np.uint8)
    kind[:n] = _CLASS[data]
    before = np.empty(n + 3, np.uint8)
    before[1:] = kind[:-1]
    before[bounds] = _NONE
    before[n:] = _NONE
    begins = kind != before
    if blanks_count:
        # The last space before something else stands alone, or before it if it is a blank.
        at = np.flatnonzero(begins & (before == _SPACE))
        begins[at - 1] = True
        begins[at[data[at - 1] == ord(" ")]] = False
    else:
        begins = (begins & (kind != _SPACE)) | (kind == _NUMBER) | (before == _NONE)
    # A contraction begins where the parts before it have ended, and ends a run of letters.
    at = np.flatnonzero((data == ord("'")) & begins[:n])
    after = np.append(data, np.zeros(3, np.uint8))
    one, two = after[at + 1], after[at + 2]
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    short = np.isin(one, list(b"stmd")) & (before[at + 1] != _NONE)
    long &= (before[at + 1] != _NONE) & (before[at + 2] != _NONE)
    for found, size in ((at[short], 2), (at[long], 3)):
        begins[found + 1] = False
        begins[found + size] |= kind[found + size] == _LETTER
    return np.flatnonzero(begins[:n])


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.large_binary())


class CachedTokenizer:
    """Ids as bytes, 16 bits each and little-endian, the same as the tokenizer's for whole texts.

    ``blanks_count`` tells byte-level vocabularies, in which a blank belongs to the next
    word, from lower-case ones that leave white space out.
    """

    dtype = np.dtype("<u2")

    def __init__(self, path: str, blanks_count: bool):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        if self.tokenizer.get_vocab_size() > np.iinfo(self.dtype).max + 1:
            raise ValueError("the ids need more than 16 bits")
        # Added tokens are found in the whole text, before it is cut, and some of them in any case.
        self.added = sorted({t.content[:2].lower() for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.any_case = any(a != a.upper() for a in self.added)
        self.blanks_count = blanks_count
        characters = _byte_characters()
        self.characters = {ord(c): "".join([characters[b] for b in c.encode()]) for c in _LATIN}
        # Parts, their ids, and how often each was found.
        self.parts, self.ids, self.found = _binary([]), _binary([]), np.zeros(0, np.int64)
        self.rare: dict[str, bytes] = {}

    @property
    def known(self) -> set[str]:
        """The parts and pieces that are kept, without the white space around them."""
        return {p.decode("latin-1").strip() for p in self.parts.to_pylist()} | {p.strip() for p in self.rare}

    def _may_hold_added(self, text: str) -> bool:
        text = text.lower() if self.any_case else text
        return any(a in text for a in self.added)

    def _whole(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [_bytes(x.ids) for x in done]

    def _part(self, part: bytes) -> bytes:
        part = part if self.blanks_count else part.rstrip(_SPACES)
        tokens = self.tokenizer.model.tokenize(part.decode("latin-1").translate(self.characters)) if part else []
        return _bytes([t.id for t in tokens])

    def _keep(self, added: pa.Array, added_ids: pa.Array, found: np.ndarray) -> None:
        """Where parts become too many, half of them stay: those found most, lately above all."""
        short = pc.less_equal(pc.binary_length(added), LONGEST_KEPT)
        parts = pa.concat_arrays([self.parts, added.filter(short)])
        ids = pa.concat_arrays([self.ids, added_ids.filter(short)])
        found = np.append(found[: len(self.parts)], found[len(self.parts) :][short.to_numpy(zero_copy_only=False)])
        if len(parts) > MOST_KEPT:
            most = np.sort(np.argsort(-found, kind="stable")[: MOST_KEPT // 2])
            parts, ids, found = parts.take(pa.array(most)), ids.take(pa.array(most)), found[most] // 2
        self.parts, self.ids, self.found = parts, ids, found

    def _latin(self, texts: list[str]) -> list[bytes]:
        """The ids of texts without characters beyond Latin-1."""
        text = "".join(texts)
        data = (text if self.blanks_count else text.lower()).encode("latin-1")
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        offsets = np.append(cut(np.frombuffer(data, np.uint8), bounds[:-1], self.blanks_count), len(data))
        firsts = np.searchsorted(offsets, bounds)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).dictionary_encode()
        del text, data, offsets, buffers
        at = pc.fill_null(pc.index_in(parts.dictionary, self.parts), -1).to_numpy(zero_copy_only=False).copy()
        new = at < 0
        at[new] = len(self.parts) + np.arange(np.count_nonzero(new))
        added = parts.dictionary.filter(pa.array(new))
        added_ids = _binary([self._part(p) for p in added.to_pylist()])
        places = at[parts.indices.to_numpy()]
        ids = pa.concat_arrays([self.ids, added_ids]).take(pa.array(places))
        found = np.bincount(places, minlength=len(self.parts) + len(added))
        found[: len(self.parts)] += self.found
        self._keep(added, added_ids, found)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        bounds, out = ends[firsts].tolist(), ids.buffers()[2] if len(ids) else None
        return [out[a:b].to_pybytes() if b > a else b"" for a, b in zip(bounds, bounds[1:], strict=False)]

    def _stretches(self, text: str) -> list[tuple[bool, str]]:
        """Pieces beyond Latin-1, one by one, and what is between them, with the blanks that belong to them."""
        pieces = text.split(" ") if self.blanks_count or _SEPARATORS.search(text) else text.split()
        if self.blanks_count:
            pieces = [p for p in [pieces[0], *(" " + p for p in pieces[1:])] if p]
        out: list[tuple[bool, str]] = []
        for beyond, group in groupby(pieces, lambda p: not _is_latin(p)):
            out += [(True, p) for p in group] if beyond else [(False, ("" if self.blanks_count else " ").join(group))]
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; a null text has none."""
        latin: list[str] = []
        #: Per text its ids in order, or the place of a stretch among ``latin``.
        made: list[list[bytes | int]] = []
        for text in texts:
            text, own = text or "", []
            made.append(own)
            if self._may_hold_added(text):
                own += self._whole([text])
            elif _is_latin(text):
                own.append(len(latin))
                latin.append(text)
            elif self.blanks_count and (text[:1] == " " or text[-1:] == " " or _UNSAFE.search(text)):
                own += self._whole([text])
            else:
                stretches = self._stretches(text)
                new = list({p for beyond, p in stretches if beyond}.difference(self.rare))
                rare = dict(zip(new, self._whole(new), strict=True))
                for beyond, stretch in stretches:
                    own.append(len(latin) if not beyond else rare[stretch] if stretch in rare else self.rare[stretch])
                    latin += [] if beyond else [stretch]
                if len(self.rare) + len(rare) > RARE_KEPT:
                    self.rare = {}
                self.rare.update((p, i) for p, i in rare.items() if len(p) <= LONGEST_KEPT)
        ids = self._latin(latin)
        return [b"".join([x if isinstance(x, bytes) else ids[x] for x in own]) for own in made]


@lru_cache(2)
def tokenizer(path: str, blanks_count: bool) -> CachedTokenizer:
    """One per Python worker, whatever the number of its tasks."""
    return CachedTokenizer(path, blanks_count)
