"""Tokenizer files, loaded once per process, and the units they encode apart."""

from __future__ import annotations

import os
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ordermill.llm import buffers

#: White space that the tokenizers know beside the six ASCII separators.
OTHER_SPACE = "[\x1c-\x1f\x85\xa0  -     　]"


#: Bytes of ASCII letters and digits, and of ASCII punctuation.
ALPHANUMERIC, PUNCTUATION = np.zeros((2, 256), dtype=bool)
ALPHANUMERIC[list((string.ascii_letters + string.digits).encode())] = True
PUNCTUATION[list(string.punctuation.encode())] = True


class Encoder:
    """A tokenizer file.  Texts that ``whole`` names must be encoded in one piece."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.widths: np.ndarray | None = None

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def apart(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units, one after the other, and how many each has.

        Units are joined by a special string, which a tokenizer cuts out before
        anything else, so each is encoded as if it stood alone.
        """
        mark = self.specials[-1]
        split = self.tokenizer.token_to_id(mark)
        joined = [mark.join(units[i : i + 1000]) for i in range(0, len(units), 1000)]
        ids = [np.array([*e.ids, split], dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        ends = np.flatnonzero(ids == split)
        return ids[ids != split], np.diff(ends, prepend=-1) - 1

    def byte_ids(self, units: pa.Array, batch: int = 10_000) -> tuple[np.ndarray, np.ndarray]:
        """What ``apart`` gives, for a byte-level tokenizer: its ids stand for fixed numbers of bytes, which tell them apart."""
        if self.widths is None:
            tokens = self.tokenizer.get_vocab(with_added_tokens=False)
            added = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
            width = {i: len(t) for t, i in tokens.items()} | added
            self.widths = np.zeros(max(width) + 1, dtype=np.int64)
            self.widths[list(width)] = list(width.values())
        out, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i in range(0, len(units), batch):
            some = units.slice(i, batch)
            ids = np.array(self.tokenizer.encode_batch_fast([some.cast(pa.large_string()).to_pylist()], is_pretokenized=True, add_special_tokens=False)[0].ids, dtype=np.uint32)
            ends = np.cumsum(self.widths[ids])
            bounds = np.cumsum(pc.binary_length(some).to_numpy())
            last = np.searchsorted(ends, bounds)
            if len(ids) <= last[-1] or (ends[last] != bounds).any():
                raise ValueError("the ids of this tokenizer do not stand for the bytes of the text")
            out.append(ids)
            sizes.append(np.diff(last, prepend=-1))
        return np.concatenate(out), np.concatenate(sizes)

    def whole(self, texts: pa.Array) -> np.ndarray:
        """Which texts hold other white space or a special string, next to which cuts may matter."""
        found = pc.match_substring_regex(texts, OTHER_SPACE)
        for special in self.specials:
            found = pc.or_(found, pc.match_substring(texts, special))
        return np.flatnonzero(pc.fill_null(found, False).to_numpy(zero_copy_only=False))


def load(path: str) -> Encoder:
    """The encoder of a file; each process reads a file once."""
    held = buffers.worker_state().setdefault("encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def unit_counts(encoder: Encoder, units: list[bytes]) -> np.ndarray:
    """The number of tokens of each unit."""
    return np.array([len(x) // 4 for x in unit_ids(encoder, units)], dtype=np.int64)


def unit_ids(encoder: Encoder, units: list[bytes]) -> list[bytes]:
    """The token ids of each unit as unsigned 32-bit little-endian numbers."""
    texts = [u.decode() for u in units]
    odd = {i for i, t in enumerate(texts) if any(s in t for s in encoder.specials)}
    flat, sizes = encoder.apart([t for i, t in enumerate(texts) if i not in odd])
    flat, ends = flat.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
    out = [flat[a:b] for a, b in zip([0, *ends], ends)]
    for i in sorted(odd):
        out.insert(i, np.array(encoder.ids(texts[i]), dtype="<u4").tobytes())
    return out


def byte_units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut texts where a byte-level BPE tokenizer always cuts: the bytes, each unit's start, each text's first unit.

    A word takes one space before it along.  Of a longer run of separators, all
    but the last character are a unit, and the last is one unless it is a space.
    ASCII punctuation that follows an ASCII letter or digit begins a unit, so a
    word is the same unit whatever stands behind it.
    """
    data, offsets = buffers.layout(texts)
    gap = buffers.SEPARATOR[data]
    head = np.zeros(len(data), dtype=bool)
    head[offsets[:-1][np.diff(offsets) > 0]] = True
    if len(data):
        word = ~gap[1:] & ~head[1:]
        run = gap[1:] & (~gap[:-1] | head[1:])
        last = gap[:-1] & word
        after = word & gap[:-1] & (data[:-1] != 32)
        start = head.copy()
        start[1:] |= run | after | (ALPHANUMERIC[data[:-1]] & PUNCTUATION[data[1:]])
        start[:-1] |= last
    else:
        start = head
    start = np.flatnonzero(start)
    return data, start, np.searchsorted(start, offsets)
