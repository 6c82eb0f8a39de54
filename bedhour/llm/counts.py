"""Operator 10: token counts by a unigram vocabulary, without making tokens.

White space separates words; a word is written with the vocabulary's space mark
in front. An Aho-Corasick automaton lists all vocabulary pieces in a word, and
dynamic programming carries, for every end, the best score and the number of
pieces on the best way there. Tie rules of the public unigram tokenizer: ways
are compared as sums of 64-bit floats from the left; among equal sums the piece
that starts first (the longest) stays; a letter no piece covers counts as
unknown, scored ``min(score) - 10``, and a run of unknown letters gives one
token, or one for each of its bytes with ``byte_fallback``.

No piece reaches over a space, so a word's count holds wherever it stands, and
each worker remembers the counts of a bounded number of words.

Defined results: a null or empty text has 0 words and 0 tokens; a word of any
length is counted whole; rows stay as they are, repeated rows and null ids
included; further columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import math
from collections import Counter as Letters
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_tasks, row_chunks, text_bytes

SPACE_MARK = "▁"
CACHED_WORDS = 600_000
ALPHABET = 128
TOGETHER_WORDS = 20_000
TOGETHER_LENGTH = 64
UNKNOWN_PENALTY = 10.0


def model_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece file with unigram scores. The file is a merge
    list whose order is by use, so the score is a Zipf log probability of the
    rank; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    # A piece with the mark inside could reach over a space.
    kept = [p for p in kept if p and SPACE_MARK not in p[1:]]
    norm = math.log(sum(1.0 / (r + 2.7) for r in range(len(kept))))
    return [(p, -math.log(r + 2.7) - norm) for r, p in enumerate(kept)]


class Automaton:
    """Aho-Corasick automaton of the vocabulary as tables, so that one step moves
    a whole array of words. It covers the ``ALPHABET`` letters most pieces use;
    words with others are counted one by one."""

    def __init__(self, pieces: list[tuple[str, float]]):
        used = Letters(c for p, _ in pieces for c in set(p))
        letters = sorted(c for c, _ in used.most_common(ALPHABET))
        column = {c: i for i, c in enumerate(letters)}
        single = {p for p, _ in pieces if len(p) == 1}
        self.covered = frozenset(c for c in letters if c in single)
        self.column = np.zeros(max(map(ord, letters), default=0) + 1, np.int32)
        for c, i in column.items():
            self.column[ord(c)] = i
        children: list[dict[int, int]] = [{}]
        own: list[tuple[int, float] | None] = [None]
        for piece, score in pieces:
            if not set(piece) <= column.keys():
                continue
            state = 0
            for c in piece:
                state = children[state].setdefault(column[c], len(children))
                if state == len(children):
                    children.append({})
                    own.append(None)
            if own[state] is None:
                own[state] = (len(piece), score)
        self.next = np.zeros((len(children), max(len(letters), 1)), np.int32)
        suffix = [0] * len(children)
        found: list[list[tuple[int, float]]] = [[] for _ in children]
        queue = [0]
        for state in queue:
            row = self.next[state]
            if state:
                row[:] = self.next[suffix[state]]
            found[state] = ([own[state]] if own[state] else []) + (found[suffix[state]] if state else [])
            for c, child in children[state].items():
                suffix[child] = int(row[c]) if state else 0
                row[c] = child
                queue.append(child)
        # Pieces that end in a state, longest first.
        counts = np.array(list(map(len, found)), np.int64)
        self.first = np.cumsum(counts) - counts
        self.matches = counts
        self.length = np.array([n for f in found for n, _ in f], np.int64)
        self.score = np.array([s for f in found for _, s in f])

    def tokens(self, marked: list[str]) -> list[int]:
        """Tokens of words whose letters are all covered."""
        sizes = np.array(list(map(len, marked)), np.int64)
        order = np.argsort(-sizes, kind="stable")
        codes = self.column[np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)]
        starts = (np.cumsum(sizes) - sizes)[order]
        ordered = sizes[order]
        best = np.full((int(ordered[0]) + 1, len(marked)), -np.inf)
        best[0] = 0.0
        tokens = np.zeros(best.shape, np.int32)
        state = np.zeros(len(marked), np.int32)
        for end in range(1, int(ordered[0]) + 1):
            active = int(np.searchsorted(-ordered, -end, side="right"))
            state = self.next[state[:active], codes[starts[:active] + end - 1]]
            first, matches = self.first[state], self.matches[state]
            top, count = best[end], tokens[end]
            for nth in range(int(matches.max(initial=0))):
                word = np.flatnonzero(matches > nth)
                match = first[word] + nth
                begin = end - self.length[match]
                total = best[begin, word] + self.score[match]
                # Longest first, so on equal sums the first to come stays.
                higher = np.flatnonzero(total > top[word])
                word = word[higher]
                top[word] = total[higher]
                count[word] = tokens[begin[higher], word] + 1
        result = np.empty(len(marked), np.int64)
        result[order] = tokens[ordered, np.arange(len(marked))]
        return result.tolist()


class Counter(dict):
    """Token counts of words (as bytes), remembered."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool):
        import ahocorasick

        self.byte_fallback = byte_fallback
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.found = ahocorasick.Automaton()
        for piece, score in pieces:
            self.found.add_word(piece, (len(piece), score))
        if pieces:
            self.found.make_automaton()
        self.single = frozenset(p for p, _ in pieces if len(p) == 1)
        self.together = Automaton(pieces)

    def tokens_of(self, texts: list[bytes | None]) -> tuple[list[int], list[int]]:
        """Words and tokens of each text. ``bytes.split`` parts at just the white
        space the word rule names."""
        parts = [text.split() if text else [] for text in texts]
        known = [list(map(self.get, words)) for words in parts]
        new = list({w for words, have in zip(parts, known, strict=True) if None in have
                    for w, n in zip(words, have, strict=True) if n is None})
        counted = dict(zip(new, self.counts(new), strict=True))
        tokens = [
            sum(have) if None not in have else sum(counted[w] if n is None else n for w, n in zip(words, have, strict=True))
            for words, have in zip(parts, known, strict=True)
        ]
        if len(self) + len(new) > CACHED_WORDS:
            self.clear()
        self.update(counted)
        return list(map(len, parts)), tokens

    def counts(self, words: list[bytes]) -> list[int]:
        marked = [SPACE_MARK + word.decode("utf-8", "replace") for word in words]
        result = [-1] * len(words)
        plain: list[int] = []
        covered = self.together.covered
        for i, text in enumerate(marked):
            if len(text) <= TOGETHER_LENGTH and covered.issuperset(text):
                plain.append(i)
            else:
                result[i] = self.count(text)
        for first in range(0, len(plain), TOGETHER_WORDS):
            rows = plain[first : first + TOGETHER_WORDS]
            for i, n in zip(rows, self.together.tokens([marked[i] for i in rows]), strict=True):
                result[i] = n
        return result

    def count(self, marked: str) -> int:
        size = len(marked)
        if self.single.issuperset(marked):
            # The automaton lists the pieces of an end longest first, and only a
            # larger sum replaces the one before.
            best, tokens = [-math.inf] * (size + 1), [0] * (size + 1)
            best[0] = 0.0
            for last, (length, score) in self.found.iter(marked):
                end = last + 1
                total = best[end - length] + score
                if total > best[end]:
                    best[end] = total
                    tokens[end] = tokens[end - length] + 1
            return tokens[size]
        return self._count_unknown(marked, size)

    def _count_unknown(self, marked: str, size: int) -> int:
        """The same where some letter is no piece of its own."""
        ends: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        if len(self.found):
            for last, piece in self.found.iter(marked):
                ends[last].append(piece)
        best = [0.0] * (size + 1)
        tokens = [0] * (size + 1)
        # Whether the way to an end finishes with an unknown letter.
        lost = [False] * (size + 1)
        for last in range(size):
            top, chosen = -math.inf, 0
            for length, score in ends[last]:
                total = best[last + 1 - length] + score
                if total > top:
                    top, chosen = total, length
            if marked[last] not in self.single:
                total = best[last] + self.unknown
                if total > top:
                    top, chosen = total, 0
            best[last + 1] = top
            if chosen:
                tokens[last + 1] = tokens[last + 1 - chosen] + 1
            else:
                lost[last + 1] = True
                if self.byte_fallback:
                    tokens[last + 1] = tokens[last] + len(marked[last].encode())
                else:
                    tokens[last + 1] = tokens[last] + (not lost[last])
        return tokens[size]


_counters: dict[int, Counter] = {}


def counter(pieces: list[tuple[str, float]], byte_fallback: bool) -> Counter:
    key = hash((tuple(pieces), byte_fallback))
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(pieces, byte_fallback)
    return _counters[key]


def token_counts(docs: DataFrame, pieces: list[tuple[str, float]], byte_fallback: bool = True) -> DataFrame:
    """``doc_id, n_words, n_tokens`` for every row of ``docs``. The vocabulary
    is a fixed file, broadcast once."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(shared.value, byte_fallback)
        for batch in batches:
            words: list[int] = []
            tokens: list[int] = []
            texts = batch.column(1).cast(pa.binary())
            for first, last in row_chunks(text_bytes(batch.column(1))[1]):
                found = counts.tokens_of(texts[first:last].to_pylist())
                words += found[0]
                tokens += found[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_words", "n_tokens"],
            )

    picked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return picked.transform(in_tasks, run, "doc_id long, n_words long, n_tokens long")
