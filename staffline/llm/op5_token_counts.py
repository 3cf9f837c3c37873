"""Token counts of whole texts by trie-shared dynamic programming.

The distinct pre-tokens (a run of spaces with the word behind it, or a line
feed) of a run of texts go into a prefix trie. The trie is walked depth first
and the unigram forward score and token count of a node are computed once, from
the nodes above it, however many pre-tokens share that prefix; at a terminal
node the count of its pre-token is stored. A text's count is the sum over its
pre-tokens. The counts equal the number of pieces of the Viterbi encoding with
the same vocabulary (byte fallback included).

Edge cases: null and empty texts count 0; repeated rows count each time; very
long pre-tokens are handled in time proportional to their length; ties between
segmentations go to the one whose last piece is longest; extra columns are
dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textvec as tv
from .common import documents
from .op7_sentencepiece import MARKER, MODEL_PATH, Vocabulary, cut

MEMO_ENTRIES = 300_000


class Scores:
    """Piece trie (nested dicts by character, the score under "") and what an uncovered character costs."""

    def __init__(self, vocabulary: Vocabulary):
        self.root: dict = {}
        self.single: set[str] = set()
        for _, piece, score in vocabulary.pieces:
            node = self.root
            text = piece.decode()
            for c in text:
                node = node.setdefault(c, {})
            node[""] = score
            if len(text) == 1:
                self.single.add(text)
        self.unknown = vocabulary.unknown


class Trie:
    """Distinct pre-tokens; ``children[node]`` by character, ``terminal`` marks ends."""

    def __init__(self, words: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        self.terminal: dict[int, str] = {}
        for word in words:
            node = 0
            for c in word:
                to = self.children[node].get(c)
                if to is None:
                    to = len(self.children)
                    self.children[node][c] = to
                    self.children.append({})
                node = to
            self.terminal[node] = word

    def counts(self, scores: Scores) -> dict[str, int]:
        """Tokens of every inserted word: one forward step per node."""
        out: dict[str, int] = {}
        root, unknown, single = scores.root, scores.unknown, scores.single
        best, tokens = [0.0], [0]
        # per depth: (start, piece node) of the pieces that can still end below, oldest start first
        live: list[list[tuple[int, dict]]] = [[(0, root)]]
        stack: list[tuple[int, int, str]] = [(to, 1, c) for c, to in self.children[0].items()]
        if 0 in self.terminal:
            out[self.terminal[0]] = 0
        while stack:
            node, depth, char = stack.pop()
            del best[depth:], tokens[depth:], live[depth:]
            score, count, following = float("-inf"), 0, []
            if char != MARKER:
                for i, piece in live[-1]:
                    to = piece.get(char)
                    if to is not None:
                        got = to.get("")
                        if got is not None and best[i] + got > score:
                            score, count = best[i] + got, tokens[i] + 1
                        following.append((i, to))
            if char not in single or char == MARKER:
                fallback = best[-1] + unknown
                if fallback > score:
                    score, count = fallback, tokens[-1] + len(char.encode("utf-8", "surrogatepass"))
            following.append((depth, root))
            best.append(score)
            tokens.append(count)
            live.append(following)
            if node in self.terminal:
                out[self.terminal[node]] = count
            for c, to in self.children[node].items():
                stack.append((to, depth + 1, c))
        return out


def count_texts(texts: list[str | None], scores: Scores, memo: dict[str, int]) -> list[tuple[int, int]]:
    """(pre-tokens, tokens) of each text; ``memo`` keeps counts between calls."""
    cuts = [cut(t) if t else [] for t in texts]
    words = {w for c in cuts for w in c}
    if len(memo) > MEMO_ENTRIES:
        memo.clear()
    memo.update(Trie(words.difference(memo)).counts(scores))
    return [(len(c), sum(map(memo.__getitem__, c))) for c in cuts]


def token_counts(docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every row of ``docs``."""
    rows = documents(docs)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, memo = Scores(shared.value), {}
        for part in tv.pieces(batches):
            found = count_texts(tv.column(part, "text").to_pylist(), scores, memo)
            counts = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([tv.column(part, "doc_id"), pa.array(counts[:, 0]), pa.array(counts[:, 1])],
                                             ["doc_id", "n_pretokens", "n_tokens"])

    return rows.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
