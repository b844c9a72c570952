"""Byte-level BPE encoding with the ``tokenizers`` library, memoised per word.

A byte-level BPE never merges across the border before a space that is directly
followed by a visible character, so a text's ids are the ids of its space-split
pieces, one after the other. ``PieceEncoder`` lets the tokenizers library encode
each distinct piece of a block of texts and gathers the ids; texts where some
space is no certain border (runs of blanks, unusual characters) are split only
at the certain ones. The result equals ``Tokenizer.encode`` on the whole text
(tests compare the two).
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct pieces a worker keeps between blocks (about 60 bytes each), beyond those of
#: its last block. Over that, it keeps the half of them that most blocks held.
CACHE_PIECES = 400_000
#: Longer pieces are not kept between blocks.
CACHE_PIECE_BYTES = 64
#: Bytes of text handled at once in a worker (a longer text is a block by itself).
BLOCK_BYTES = 8_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PieceEncoder:
    """Arrays of texts to ids. Known pieces are an Arrow array; the ids of piece i
    are ``pool[starts[i] : starts[i] + sizes[i]]`` and hold the blank before it."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.blank_first = np.array([(self.tokenizer.id_to_token(i) or "").startswith(("Ġ", " ")) for i in range(size)])
        #: a mark that ends a piece, after a letter, is always tokens of its own
        self.marks = {m: self._each([m])[0] for m in ".,"}
        self.cache_pieces = cache_pieces
        self.known = pa.array([], pa.large_string())
        self.pool, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        #: the blocks that held a piece, halved whenever pieces are dropped
        self.held = np.zeros(0, np.int32)

    def _keep(self, at: np.ndarray) -> None:
        """Forget all pieces but those at these places."""
        self.pool, self.known = self._gather(at), self.known.take(pa.array(at))
        self.sizes, self.held = self.sizes[at], self.held[at]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _trim(self) -> None:
        """Drop long pieces, and the rare ones if there are too many."""
        short = pc.less_equal(pc.binary_length(self.known), CACHE_PIECE_BYTES).to_numpy(zero_copy_only=False)
        if len(self.known) > self.cache_pieces:
            often = np.flatnonzero(short)
            most = self.cache_pieces // 2
            if len(often) > most:  # of pieces that equally many blocks held, the last ones
                often = np.sort(often[np.argsort(self.held[often], kind="stable")[-most:]])
            self._keep(often)
            self.held = np.maximum(self.held // 2, 1)
        elif not short.all():
            self._keep(np.flatnonzero(short))

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of pieces, encoded in one run: a token that starts with a
        blank starts a piece."""
        ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(pieces)], add_special_tokens=False)[0].ids, np.uint32)
        at = np.flatnonzero(self.blank_first[ids])
        if len(at) == len(pieces):
            return ids, np.diff(np.append(at, len(ids)))
        each = self._each([" " + p for p in pieces])
        return np.concatenate(each), np.array([len(x) for x in each])

    def _add(self, pieces: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, pieces])
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
        self.pool = np.concatenate([self.pool, ids])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.held = np.concatenate([self.held, np.zeros(len(sizes), np.int32)])

    def _gather(self, at: np.ndarray) -> np.ndarray:
        n = self.sizes[at]
        ends = np.cumsum(n)
        places = np.repeat((self.starts[at] - ends + n).astype(np.int32), n)
        places += np.arange(len(places), dtype=np.int32)
        return self.pool[places]

    def _places(self, words: pa.Array) -> np.ndarray:
        """Places in the known pieces of distinct words that start at a sure border;
        new ones are encoded and added."""
        marked = pc.match_substring_regex(words, r"\p{L}[.,]$")
        ended = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        base = pc.utf8_slice_codeunits(words.filter(marked), 0, -1)
        every = pc.unique(pa.concat_arrays([words, base]))  # the words come first
        at = pc.fill_null(pc.index_in(every, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        base = pc.index_in(base, value_set=every).to_numpy(zero_copy_only=False).astype(np.int64)
        by_base = at < 0
        new = by_base.copy()
        new[ended] = False
        new[base] |= at[base] < 0
        by_base &= ~new
        fresh = every.filter(pa.array(new))
        pieces = fresh.to_pylist()
        found = [self._joined(pieces[i : i + 2000]) for i in range(0, len(pieces), 2000)]
        if found:
            at[new] = len(self.known) + np.arange(len(pieces))
            self._add(fresh, np.concatenate([x for x, _ in found]), np.concatenate([n for _, n in found]))
        lasts = pc.utf8_slice_codeunits(words.filter(marked), -1)
        for mark, tail in self.marks.items():
            has = by_base[ended] & pc.equal(lasts, mark).to_numpy(zero_copy_only=False)
            which, stem = ended[has], at[base[has]]
            if len(which):
                sizes = self.sizes[stem]
                ids = np.insert(self._gather(stem), np.repeat(np.cumsum(sizes), len(tail)), np.tile(tail, len(stem)))
                at[which] = len(self.known) + np.arange(len(which))
                self._add(words.take(pa.array(which)), ids, sizes + len(tail))
        self.held[at[at >= 0]] += 1
        return at[: len(words)]

    def _block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = pc.split_pattern(texts, " ")
        flat = parts.flatten()
        first = parts.offsets.to_numpy()
        first = first - first[0]
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary
        sure = pc.match_substring_regex(words, r"^[!-~\p{L}]")
        place = np.full(len(words), -1)
        place[sure.to_numpy(zero_copy_only=False)] = self._places(words.filter(sure))
        codes = place[codes]
        # a text's first piece has no blank before it; a text with an unsure border goes whole
        codes[first[:-1]] = 0
        whole = np.unique(np.searchsorted(first, np.flatnonzero(codes < 0), "right") - 1)
        alone = flat.take(pa.array(first[:-1])).to_pylist()
        for d in whole.tolist():
            alone[d] = texts[d].as_py()
            codes[first[d] : first[d + 1]] = -1
        codes[first[:-1]] = -1
        rest = codes >= 0
        ids = self._gather(codes[rest])
        sizes = np.where(rest, self.sizes[codes], 0) if len(self.sizes) else np.zeros(len(codes), np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])[first]
        heads = self._each(alone)
        n_heads = np.array([len(x) for x in heads])
        ids = np.insert(ids, np.repeat(ends[:-1], n_heads), np.concatenate(heads))
        self._trim()
        return ids, ends + np.concatenate([[0], np.cumsum(n_heads)])

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Blocks of consecutive texts (null counts as empty): the place of the
        first one, all their ids (uint32), and len + 1 borders of the texts in it."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            done = ends[at - 1] if at else 0
            n = max(1, int(np.searchsorted(ends, done + BLOCK_BYTES, "right")) - at)
            yield (at, *self._block(texts.slice(at, n)))
            pa.default_memory_pool().release_unused()
            at += n


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker process's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
