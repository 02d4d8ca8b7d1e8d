"""Whole texts to token ids with a public tokenizer, pre-token by pre-token.

For a tokenizer that drops white space (its normaliser and its pre-tokenizer
never look across it) the ids of a text are those of its white-space separated
words in order.  Where the pre-tokenizer also separates letters from
punctuation, punctuation after a word's last letter is a pre-token of its own;
a tokenizer that lower-cases gives ASCII words the same ids in lower case.  So
a task asks the library once per distinct pre-token it meets and looks the
others up.  ``tests/llm`` compares this with the library on whole texts.
"""

from __future__ import annotations

from itertools import repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loadbay.llm.words import blocks, buffers

#: Distinct words of a shard that a task of ``token_counts`` keeps.
KEEP = 800_000
#: Distinct pre-tokens in a worker's store, which outlives the task; a full
#: store keeps the half that most calls asked for.
STORED = 250_000
#: Characters of pre-tokens per call of the library (or one longer pre-token).
CALL = 5_000
_AFTER = ".,;:!?&$%#*|)"

_encoders: dict[str, PieceEncoder] = {}


class PieceEncoder:
    """Ids of pre-tokens, from the library once per distinct pre-token."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        wide = self.library.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.dtype = np.uint32 if wide else np.uint16
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, self.dtype)
        self.edge = np.zeros(1 << 16, np.int64)  # ids of number i: flat[edge[i]:edge[i + 1]]
        self.uses = np.zeros(1 << 16, np.float32)  # calls that asked for number i

    def thin(self) -> None:
        """Keep the half of a full store that most calls asked for, of equal
        ones the newer; calls before this one count half from now on."""
        n = len(self.known)
        keep = np.sort(np.argsort(self.uses[:n], kind="stable")[n - STORED // 2:])
        names = list(self.known)  # in the order of their numbers
        size = np.diff(self.edge[: n + 1])[keep]
        end = np.cumsum(size)
        where = np.repeat(self.edge[keep] - (end - size), size) + np.arange(size.sum())
        self.flat[: len(where)] = self.flat[where]
        self.edge[1: len(keep) + 1] = end
        self.uses[: len(keep)] = self.uses[keep] / 2
        self.uses[len(keep):] = 0
        self.known = {names[i]: k for k, i in enumerate(keep.tolist())}

    def counted(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in order, and how many each piece has.

        The library gets many pieces as one text, which takes less time than a
        list; an id is of the piece that it starts in."""
        ids, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        edge = np.cumsum([0] + [len(x) + 1 for x in pieces])
        for i, j in blocks(edge, CALL):
            got = self.library.encode(" ".join(pieces[i:j]), add_special_tokens=False)
            ids.append(np.array(got.ids, np.int64))
            if j == i + 1:
                sizes.append(np.array([len(ids[-1])]))
                continue
            start = np.fromiter(map(itemgetter(0), got.offsets), np.int64, len(ids[-1])) + edge[i]
            sizes.append(np.bincount(np.searchsorted(edge[i + 1: j + 1], start, "right"), minlength=j - i))
        return np.concatenate(ids), np.concatenate(sizes)

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The store's number of every piece (no two alike); new ones are encoded."""
        if len(self.known) > STORED:
            self.thin()
        known = self.known
        number = np.fromiter(map(known.get, pieces, repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(number < 0)
        if len(unknown):
            new = [pieces[i] for i in unknown.tolist()]
            ids, sizes = self.counted(new)
            n = len(known)
            at = int(self.edge[n])
            while at + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            while n + len(new) >= len(self.edge):
                self.edge = np.concatenate([self.edge, np.zeros_like(self.edge)])
                self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
            self.flat[at: at + len(ids)] = ids
            self.edge[n + 1: n + len(new) + 1] = at + np.cumsum(sizes)
            known.update(zip(new, range(n, n + len(new))))
            number[unknown] = np.arange(n, n + len(new))
        self.uses[number] += 1
        return number


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of this file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def cut(word: str) -> tuple[str, str]:
    """A word and the punctuation after its last letter.

    A special token's string stays whole.  Letters whose lower case or
    composition could end in a mark are not cut after."""
    if "<" in word:
        return word, ""
    if word.isascii():
        word = word.lower()
    core = word.rstrip(_AFTER)
    if core == word or not core or not core[-1].isalpha() or ord(core[-1]) > 0x24F or len(core[-1].lower()) > 1:
        return word, ""
    return core, word[len(core):]


def strings(words: pa.Array) -> list[str]:
    """The words as a list; ``to_pylist`` takes eight times as long."""
    return words.to_numpy(zero_copy_only=False).tolist()


def cuts(words: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """``cut`` of many words: what stays of each, which have punctuation cut
    off, and that.  Plain ASCII words are cut by Arrow, all at a time; of the
    others only those with punctuation at the end are looked at one by one."""
    plain = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<")))
    low = pc.if_else(plain, pc.ascii_lower(words), words)
    core = pc.ascii_rtrim(low, characters=_AFTER)
    data, edge = buffers(core)
    size = np.diff(edge)
    last = np.zeros(len(words), np.uint8)
    last[size > 0] = data[edge[1:][size > 0] - 1]
    plain = plain.to_numpy(zero_copy_only=False)
    shorter = size < np.diff(buffers(low)[1])
    is_cut = plain & (size > 0) & shorter & (last >= 97) & (last <= 122)
    at = np.flatnonzero(is_cut)
    ends = [w[n:] for w, n in zip(strings(low.take(pa.array(at))), size[at].tolist())]
    other = np.flatnonzero(shorter & ~plain)
    pairs = [cut(w) for w in strings(words.take(pa.array(other)))]
    more = [k for k, (_, y) in enumerate(pairs) if y]
    kept = pc.if_else(pa.array(is_cut), core, low)
    if pairs:
        kept = pc.replace_with_mask(kept, pa.array(shorter & ~plain), pa.array([x for x, _ in pairs], kept.type))
    return kept, np.concatenate([at, other[more]]), pa.array(ends + [pairs[k][1] for k in more], kept.type)


def pre_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Each text's range of pre-tokens, every pre-token's place in the list of
    distinct ones, and that list."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    at = np.asarray(lists.offsets, np.int64)
    coded = lists.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
    code = np.asarray(coded.indices)
    cores, cut_words, ends = cuts(coded.dictionary)
    numbered = pa.concat_arrays([cores, ends]).dictionary_encode()
    place = np.asarray(numbered.indices)
    both = np.full((len(cores), 2), -1, place.dtype)  # a word's own place and that of what was cut off, if any
    both[:, 0] = place[: len(cores)]
    both[cut_words, 1] = place[len(cores):]
    out = both.take(code, axis=0).ravel()
    end = np.cumsum((1 + (both[:, 1] >= 0))[code])
    return np.concatenate([[0], end])[at - at[0]], out[out >= 0].astype(np.int64), strings(numbered.dictionary)


def text_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and each text's range."""
    enc = encoder(path)
    at, code, names = pre_tokens(texts)
    number = enc.numbers(names)
    first, size = enc.edge[number], enc.edge[number + 1] - enc.edge[number]
    n = size[code]
    end = np.concatenate([[0], np.cumsum(n)])
    where = np.repeat(first[code] - end[:-1], n) + np.arange(end[-1])
    return enc.flat[where], end[at]
