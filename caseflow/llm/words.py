"""Batches of texts as distinct words and codes, and a memo over words: the
tokenizer operators work a word out once per batch at most."""

from __future__ import annotations

import gc
from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 6 << 20


class Memo:
    """Values of the most recent keys, made where missing.  Two generations:
    when the younger is full, the older one is let go.  Long keys are not
    kept."""

    def __init__(self, make: Callable[[list[str]], list], most: int = 150_000, longest: int = 64):
        self.make, self.most, self.longest = make, most, longest
        self.young, self.old = {}, {}

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def all(self, keys: list[str]) -> list:
        """The values of the distinct ``keys``, in their order."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        got = list(map(young.get, keys))
        make = []
        for i, v in enumerate(got):
            if v is None:
                k = keys[i]
                v = old.get(k)
                if v is None:
                    make.append(i)
                else:
                    got[i] = young[k] = v
        if make:
            for i, v in zip(make, self.make([keys[i] for i in make]), strict=True):
                got[i] = v
                if len(keys[i]) <= self.longest:
                    young[keys[i]] = v
        return got


@contextmanager
def remembering(*memos: Memo):
    """For the time of a task.  Memos end with it, and Arrow gives memory back
    at once, as a worker goes on to other work.  Python's search for reference
    cycles is off: it goes through all entries again and again, and they make
    no cycles."""
    pa.set_memory_pool(pa.system_memory_pool())
    gc.disable()
    try:
        yield
    finally:
        gc.enable()
        for m in memos:
            m.clear()


class Split:
    """Texts cut at spaces: ``array`` and ``words`` (distinct), ``codes`` (of all
    words, text after text) and ``offsets``, for the texts in the order ``order``."""

    def __init__(self, texts: pa.Array, special: str, cut: Callable[[str], list[str]]):
        """Texts in which the RE2 pattern ``special`` is found, and empty
        ones, are cut by ``cut``; the others at every space."""
        odd = pc.or_(pc.match_substring_regex(texts, special), pc.equal(pc.binary_length(texts), 0))
        odd = odd.to_numpy(zero_copy_only=False)
        plain, slow = np.flatnonzero(~odd), np.flatnonzero(odd)
        lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
        parts, sizes = [lists.flatten()], [np.diff(lists.offsets.to_numpy())]
        if len(slow):
            cuts = [cut(t) for t in texts.take(pa.array(slow)).to_pylist()]
            parts.append(pa.array([c for x in cuts for c in x], pa.string()))
            sizes.append(np.array([len(x) for x in cuts]))
        coded = pa.concat_arrays(parts).dictionary_encode()
        self.array = coded.dictionary
        self.codes = coded.indices.to_numpy()
        self.offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        self.order = np.concatenate([plain, slow])

    @property
    def words(self) -> list[str]:
        return self.array.to_pylist()

    def back(self, values):
        """Values in ``order`` as they were in the batch."""
        place = np.empty(len(self.order), np.int64)
        place[self.order] = np.arange(len(self.order))
        return values[place] if isinstance(values, np.ndarray) else values.take(pa.array(place))


def bounded(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> list[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size) // most
    starts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
    return [batch.slice(a, b - a) for a, b in
            zip(starts, [*starts[1:], batch.num_rows], strict=True)]


def ragged_take(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[start:start + size]`` of all, one after the other."""
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0)
    return flat[at + np.repeat(starts - (ends - sizes), sizes)]


class IdTable:
    """Ids of words, in arrays: ``flat[starts[k]:starts[k] + sizes[k]]`` of the
    word at place k.  Words are looked up and added a batch at a time; beyond
    ``most`` words, those of the last batch stay alone."""

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int):
        """``encode`` gives all ids of an array of words, and their numbers."""
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.string())
        self.flat, self.starts, self.sizes = (np.empty(0, t) for t in ("<u4", np.int64, np.int64))

    def _add(self, words: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat])

    def places(self, words: pa.Array) -> np.ndarray:
        """The places of distinct ``words``, made where missing; they hold
        until the next call."""
        at = pc.index_in(words, value_set=self.words)
        if len(self.words) + at.null_count > self.most:
            held = at.drop_null()
            old, starts, sizes = self.words.take(held), self.starts, self.sizes
            flat, held = self.flat, np.asarray(held)
            self.clear()
            self._add(old, ragged_take(flat, starts[held], sizes[held]), sizes[held])
            at = pc.index_in(words, value_set=self.words)
        if at.null_count:
            new = words.filter(pc.is_null(at))
            count = len(self.words)
            self._add(new, *self.encode(new))
            out = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            out[out < 0] = count + np.arange(len(new))
            return out
        return np.asarray(at, np.int64)
