"""Whole texts to token ids with a public tokenizer file, each distinct piece of text encoded once.

The tokenizers split a text before they merge, and never across certain
boundaries.  A text is cut at such boundaries only, so that encoding the parts
gives the ids of the whole; parts repeat, and a task remembers those it has seen.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: White space as the byte-level tokenizers' patterns see it (fixed values of Unicode).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: One blank goes with the word behind it; a longer run leaves its last blank to that word.
PARTS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


#: Marks that may stand for a cut; one that no text of a slice holds is taken.
MARKS = ("\x00", "\x01", "\x02", "\x03", "\ue000", "\ue001", "\uf8ff")
#: Marks at the end of a word are a part of their own if a letter stands before them.
TAIL = ".,!|*#$%&"


def blank_separated(texts: pa.Array) -> pa.ListArray:
    """Parts for tokenizers that lower-case and drop white space: words between ASCII white space."""
    return pc.ascii_split_whitespace(pc.ascii_lower(texts))


def blank_led(texts: pa.Array) -> pa.ListArray:
    """Parts for byte-level tokenizers that keep white space: a blank goes with the word behind it.

    Texts with white space behind a blank, or a blank at the end, are cut by PARTS,
    the others before each blank.
    """
    mark = next((m for m in MARKS if not pc.any(pc.match_substring(texts, m)).as_py()), None)
    if mark is None:
        return pa.array([PARTS.findall(t) for t in texts.to_pylist()], pa.list_(pa.string()))
    odd = pc.or_(pc.match_substring_regex(texts, f" [{SPACE}]"), pc.ends_with(texts, " "))
    marked = pc.replace_substring(texts, " ", mark + " ")
    if pc.any(odd).as_py():
        cut = [mark.join(PARTS.findall(t)) for t in texts.filter(odd).to_pylist()]
        marked = pc.replace_with_mask(marked, odd, pa.array(cut, pa.string()))
    return pc.split_pattern(marked, mark)


SLICE_CHARS = 4_000_000
#: Parts that an encoder remembers at most, and the longest that it does.
REMEMBERED, LONGEST = 400_000, 100
JOINED = 100


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (size[i] of them) for each i in turn."""
    into = np.cumsum(size) - size
    return np.repeat(first - into, size) + np.arange(int(size.sum()))


def letters(values: pa.Array) -> pa.Array:
    """True for strings of letters that lower-case to letters, one to one."""
    return pc.and_(pc.utf8_is_alpha(values), pc.invert(pc.match_substring(values, "\u0130")))


def halves(parts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(the part before its closing marks, those marks); a part whose marks follow no letter stays whole.

    A letter and such a mark never fall into one unit of the tokenizers' patterns,
    also after lower-casing.
    """
    base = pc.utf8_rtrim(parts, TAIL)
    cut = letters(pc.utf8_slice_codeunits(base, -1))
    marks = pc.struct_field(pc.extract_regex(parts, f"(?P<tail>[{TAIL}]*)$"), "tail")
    return pc.if_else(cut, base, parts), pc.if_else(cut, marks, "")


@dataclass(frozen=True)
class Cut:
    """How texts are cut for a tokenizer file, and how words of letters can be encoded many at a time.

    Such words are joined by ``glue`` and told apart by the tokens that carry
    ``mark`` at the end (or, ``leads``, at the start) of a word.
    """

    parts: Callable[[pa.Array], pa.ListArray]
    glue: str
    mark: str
    leads: bool

    def of_letters(self, units: pa.Array) -> np.ndarray:
        if self.leads:
            found = pc.and_(pc.starts_with(units, " "), letters(pc.utf8_slice_codeunits(units, 1)))
        else:
            found = letters(units)
        return found.to_numpy(zero_copy_only=False)


#: By tokenizer file: words end in ``</w>``, or start with the letter that stands for a blank.
CUTS = {"word_bpe_49k.json": Cut(blank_separated, " ", "</w>", False), "byte_bpe_50k.json": Cut(blank_led, "", "\u0120", True)}


@functools.cache
def encoder(file: str) -> Encoder:
    """The process's encoder for a tokenizer file: later tasks of a worker find what it remembers."""
    return Encoder(file)


class Encoder:
    """Ids of texts, as one call of the tokenizer per text gives them.

    Remembers up to REMEMBERED distinct parts; when there are more, the half that
    was met in more slices (older ones count less) is kept.
    """

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
        self.tokenizer.model._resize_cache(0)  # every unit comes once
        self.cut = CUTS[file]
        #: Strings that stand for one token wherever they occur, perhaps in any case.
        self.special = sorted({t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()})
        vocabulary = self.tokenizer.get_vocab()
        self.marked = np.zeros(max(vocabulary.values()) + 1, bool)
        at_edge = str.startswith if self.cut.leads else str.endswith
        self.marked[[i for t, i in vocabulary.items() if at_edge(t, self.cut.mark)]] = True
        self.place: dict[str, int] = {}
        self.ids, self.ends, self.met = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, np.float32)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(size.sum())), size

    def units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, number of ids of each); units of letters are encoded many at a time."""
        easy = self.cut.of_letters(units)
        words = units.filter(pa.array(easy))
        groups = pa.ListArray.from_arrays(pa.array([*range(0, len(words), JOINED), len(words)], pa.int32()), words)
        ids, _ = self._encoded(pc.binary_join(groups, self.cut.glue).to_pylist() if len(words) else [])
        edges = np.flatnonzero(self.marked[ids])
        if len(edges) != len(words):
            raise ValueError("joined words do not come apart again")
        size = np.diff(edges, append=len(ids)) if self.cut.leads else np.diff(edges, prepend=-1)
        more, more_size = self._encoded(units.filter(pa.array(~easy)).to_pylist())
        sizes, first = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
        sizes[easy], sizes[~easy] = size, more_size
        first[easy], first[~easy] = np.cumsum(size) - size, len(ids) + np.cumsum(more_size) - more_size
        return np.append(ids, more)[spread(first, sizes)], sizes

    def learn(self, parts: pa.Array) -> None:
        """Encode parts not met before: their bases and closing marks apart, each distinct one once."""
        base, tail = (x.dictionary_encode() for x in halves(parts))
        ids, size = self.units(pa.concat_arrays([base.dictionary, tail.dictionary]))
        first = np.cumsum(size) - size
        both = np.empty(2 * len(parts), np.int64)
        both[0::2] = base.indices.to_numpy()
        both[1::2] = tail.indices.to_numpy() + len(base.dictionary)
        whole = size[both].reshape(-1, 2).sum(1)
        self.place.update(zip(parts.to_pylist(), range(len(self.place), len(self.place) + len(parts)), strict=True))
        self.ends = np.append(self.ends, len(self.ids) + np.cumsum(whole))
        self.met = np.append(self.met, np.zeros(len(parts), np.float32))
        self.ids = np.append(self.ids, ids[spread(first[both], size[both])])

    def forget(self) -> None:
        """Keep the half of the parts that was met most; long ones go."""
        names = list(self.place)
        short = np.fromiter(map(len, names), np.int64, len(names)) <= LONGEST
        kept = np.sort(np.argsort(np.where(short, self.met, -1), kind="stable")[-(REMEMBERED // 2):])
        kept = kept[short[kept]]
        first, size = self.ends[kept], np.diff(self.ends)[kept]
        self.ids, self.met = self.ids[spread(first, size)], self.met[kept] / 2
        self.ends = np.append(0, np.cumsum(size))
        self.place = dict(zip(map(names.__getitem__, kept.tolist()), range(len(kept)), strict=True))

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text), ``end`` behind each text.

        A text that holds a special token's string is encoded by one call.
        """
        lowered, whole = pc.utf8_lower(texts), np.zeros(len(texts), bool)
        for token in self.special:
            whole |= pc.match_substring(lowered, token).to_numpy(zero_copy_only=False)
        del lowered
        if not whole.any():
            return self._by_parts(texts, end)
        ids, sizes = self._by_parts(pc.if_else(pa.array(whole), "", texts), end)
        lists = np.split(ids, np.cumsum(sizes)[:-1])
        for i in np.flatnonzero(whole).tolist():
            own, _ = self._encoded([texts[i].as_py()])
            lists[i] = np.append(own, np.int32(end))
        return np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))

    def _by_parts(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.place) > REMEMBERED or len(self.ids) > 16 * REMEMBERED:
            self.forget()
        parts = self.cut.parts(texts)
        coded = parts.flatten().dictionary_encode()
        values = coded.dictionary.to_pylist()
        where = np.fromiter(map(self.place.get, values, itertools.repeat(-1)), np.int64, len(values))
        new = np.flatnonzero(where < 0)
        if len(new):
            where[new] = len(self.place) + np.arange(len(new))
            self.learn(coded.dictionary.take(pa.array(new)))
        self.met[where] += 1
        # every distinct part's ids, the end of a text as one more; then the texts' parts by number
        first, size = self.ends[where], np.diff(self.ends)[where]
        known = np.append(self.ids[spread(first, size)], np.int32(end))
        edges = np.append(np.append(0, np.cumsum(size)), len(known))
        offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        which = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), offsets[1:], len(values))
        out = pa.LargeListArray.from_arrays(pa.array(edges), pa.array(known)).take(pa.array(which))
        ends = out.offsets.to_numpy()[offsets + np.arange(len(offsets))]
        return out.flatten().to_numpy(zero_copy_only=False), np.diff(ends)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded length together; one very long text is a range of its own."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if size and size + n > SLICE_CHARS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def id_lists(ids: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """An Arrow column of lists over one array of ids."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(ids))


def crc_of_lists(lists: pa.ListArray) -> pa.Array:
    """Unsigned crc32 of each list's ids as little-endian unsigned 32-bit integers."""
    import zlib

    flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
    sizes = np.diff(lists.offsets.to_numpy())
    ends = np.cumsum(sizes)
    view = memoryview(flat).cast("B") if len(flat) else memoryview(b"")
    return pa.array([zlib.crc32(view[4 * (e - s):4 * e]) for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.int64())
