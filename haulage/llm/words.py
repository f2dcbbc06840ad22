"""Token ids of texts through ids of their words.

A tokenizer that never joins characters across a boundary gives the same ids for a text as for its units between the
boundaries, one after the other. Most units of a corpus occur again and again, so each is encoded by the library once and
looked up from then on.
"""

from __future__ import annotations

import re
from collections.abc import Collection

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units kept per Python worker, in two generations: what the older one holds is moved up when met again.
KEPT = 400_000
#: A private character between units that are encoded in one call.
MARK = ""
#: Letters in lower case, and marks that never begin a contraction or a special token (fixed values).
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"
#: Letters in any case and marks behind them.
PLAIN = f"^[A-Za-zÀ-ÖØ-öø-ÿ]*[{re.escape(MARKS)}]*$"


class UnitIds:
    """Ids of units as little-endian bytes of ``dtype``; ``encode`` turns a list of units into a list of id lists."""

    def __init__(self, encode, dtype: str, kept: int = KEPT):
        self.encode, self.dtype, self.kept = encode, np.dtype(dtype), kept
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def add(self, units: Collection[str], encode=None) -> None:
        """Make sure that each of these different units can be looked up; ``encode`` stands in for the one of the table."""
        if len(self.new) + len(units) > self.kept:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        missing = []
        for unit in units:
            if unit not in new:
                ids = old.get(unit)
                if ids is None:
                    missing.append(unit)
                else:
                    new[unit] = ids
        for start in range(0, len(missing), 20_000):
            part = missing[start:start + 20_000]
            for unit, ids in zip(part, (encode or self.encode)(part)):
                new[unit] = np.asarray(ids, self.dtype).tobytes()

    def join(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of each text, given as its units."""
        self.add(set().union(*texts) if texts else set())
        look = self.new.__getitem__
        return [b"".join(map(look, each)) for each in texts]


class TextIds:
    """Ids of whole texts by a tokenizer that splits at spaces and line breaks.

    Units are cut, told apart and put together again as Arrow arrays; Python sees a unit once for all texts of a call. If the tokenizer
    allows it (see ``model_encode``), units of letters and marks behind them are looked up as lower-case letters and as marks.
    """

    def __init__(self, tokenizer, dtype: str, kept: int = KEPT):
        self.units, self.straight = UnitIds(marked_encode(tokenizer), dtype, kept), model_encode(tokenizer)
        self.dtype = self.units.dtype

    def looked_up(self, units: pa.Array, encode=None) -> pa.Array:
        names = units.to_numpy(zero_copy_only=False).tolist()
        self.units.add(names, encode)
        return pa.array([self.units.new[name] for name in names], pa.large_binary())

    def of_units(self, units: pa.Array) -> pa.Array:
        """The ids of different units."""
        if self.straight is None:
            return self.looked_up(units)
        plain = pc.match_substring_regex(units, pattern=PLAIN)
        lower, odd = pc.utf8_lower(units.filter(plain)), units.filter(pc.invert(plain))
        parts = pa.concat_arrays([pc.ascii_rtrim(lower, characters=MARKS), pc.utf8_ltrim(lower, characters=LETTERS)]).dictionary_encode()
        ids, n = self.looked_up(parts.dictionary, self.straight).take(parts.indices), len(lower)
        joined = pc.binary_join_element_wise(ids[:n], ids[n:], pa.scalar(b"", pa.large_binary()))
        flags = plain.to_numpy(zero_copy_only=False)
        place = np.empty(len(flags), np.int64)
        place[np.concatenate([np.flatnonzero(flags), np.flatnonzero(~flags)])] = np.arange(len(flags))
        return pa.concat_arrays([joined, self.looked_up(odd)]).take(pa.array(place))

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and the ids of all texts one after the other; ``end`` stands behind each text. No nulls."""
        if not len(texts):
            return np.empty(0, np.int64), np.empty(0, self.dtype)
        cut = pc.split_pattern(pc.replace_substring(texts, pattern="\n", replacement=" "), pattern=" ")
        stops = np.cumsum(pc.list_value_length(cut).to_numpy(), dtype=np.int64)
        units = cut.flatten().dictionary_encode()
        table = pa.concat_arrays([self.of_units(units.dictionary), pa.array([np.asarray([end], self.dtype).tobytes()], pa.large_binary())])
        ids = table.take(pa.array(np.insert(units.indices.to_numpy(), stops, len(table) - 1)))
        offsets = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1) // self.dtype.itemsize
        return np.diff(offsets[stops + np.arange(1, len(stops) + 1)], prepend=0), np.frombuffer(ids.buffers()[2], self.dtype, int(offsets[-1]))


def marked_encode(tokenizer):
    """Encode units many to a call: joined by a mark, and cut at the ids of the mark.

    For tokenizers that split at spaces. A unit that holds the mark is encoded by itself.
    """
    mark = np.asarray(tokenizer.encode(MARK, add_special_tokens=False).ids)
    size = len(mark)

    def encode(units: list[str]):
        plain = [u for u in units if MARK not in u]
        odd = iter(tokenizer.encode_batch_fast([u for u in units if MARK in u], add_special_tokens=False)) if len(plain) < len(units) else iter(())
        groups = [plain[i:i + 64] for i in range(0, len(plain), 64)]
        found: list = []
        for group, encoded in zip(groups, tokenizer.encode_batch_fast([f" {MARK} ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.asarray(encoded.ids, np.int64)
            n = max(0, len(ids) - size + 1)
            at = np.flatnonzero(np.logical_and.reduce([ids[j:n + j] == mark[j] for j in range(size)])) if n else np.empty(0, np.int64)
            if len(at) != len(group) - 1:
                raise ValueError("the tokenizer joins the mark with its neighbours")
            starts, ends = [0, *(at + size).tolist()], [*at.tolist(), len(ids)]
            found += [ids[a:b] for a, b in zip(starts, ends)]
        whole = iter(found)
        for unit in units:
            yield next(odd).ids if MARK in unit else next(whole)

    return encode


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones stand for themselves, the others follow
    behind the 256 in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


def model_encode(tokenizer):
    """Encode runs of lower-case letters or of marks, each a piece of its own to the pre-tokenizer, straight by the tokenizer's model.
    None if this tokenizer does more with such units: each letter in both cases and each pair of marks is tried, and special tokens
    must hold a sign that is neither."""
    letters = byte_letters()
    tokenize = tokenizer.model.tokenize

    def encode(units: list[str]):
        for unit in units:
            piece = unit if unit.isascii() else "".join([letters[b] for b in unit.encode()])
            yield [t.id for t in tokenize(piece)]

    if any(set(t.content.lower()) <= {*LETTERS, *MARKS} for t in tokenizer.get_added_tokens_decoder().values()):
        return None
    words = ["the", "internationalisation", "straße", "élève", "ñandú", "þæöåø", *LETTERS, *(f"b{c}d" for c in LETTERS)]
    samples = [(unit, (word,)) for word in words for unit in (word, "".join(c if c in "ßÿ" else c.upper() for c in word))]
    samples += [(f"Ab{a}{b}", ("ab", a + b)) for a in MARKS for b in ("", *MARKS)] + [(a + b, (a + b,)) for a in MARKS for b in ("", *MARKS)]
    whole = tokenizer.encode_batch([unit for unit, _ in samples], add_special_tokens=False)
    same = all(e.ids == [i for ids in encode(parts) for i in ids] for e, (_, parts) in zip(whole, samples))
    return encode if same else None


def kept_with(library, key: str, make):
    """An object kept in an imported library, so that it outlives the task in a reused Python worker."""
    store = library.__dict__.setdefault("_haulage_kept", {})
    if key not in store:
        store[key] = make()
    return store[key]
