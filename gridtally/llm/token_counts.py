"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens.

Distinct pre-tokens go into a trie. A node holds the best score of any segmentation of its prefix
and the tokens of that segmentation, computed once from the nodes above it; so pre-tokens with a
common prefix share its work, and the node at which a pre-token ends holds its count. Each worker
keeps its trie from batch to batch, up to a number of nodes.

The vocabulary file at hand ranks its pieces instead of giving probabilities: a piece's score is
-log(1 + rank), as Zipf's law has it. A character that is no piece costs the worst score less 10
and counts one token for each of its UTF-8 bytes. Of equal scores the fewer tokens win.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.cluster import ship
from gridtally.llm.pieces import as_texts, pieces

_MAX_NODES = 600_000
UNKNOWN_PENALTY = 10.0


def unigram_scores(path: str) -> dict[str, float]:
    """Score of each piece, from its rank in the file."""
    ranked = sorted(pieces(path).merges.items(), key=lambda x: (-x[1][0], x[1][1]))
    return {piece: -log(1 + rank) for rank, (piece, _) in enumerate(ranked, 1)}


class Trie:
    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        # lengths of the pieces that end with two given characters, so that few are looked up
        ends: dict[str, set[int]] = {}
        for piece in scores:
            if len(piece) > 1:
                ends.setdefault(piece[-2:], set()).add(len(piece))
        self.ends = {pair: tuple(sorted(lengths)) for pair, lengths in ends.items()}
        self.clear()

    def clear(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.best: list[float] = [0.0]
        self.tokens: list[int] = [0]
        self.counts: dict[str, int] = {}

    def insert(self, token: str) -> int:
        """Tokens of the best segmentation of `token`."""
        children, best, tokens = self.children, self.best, self.tokens
        scores, ends = self.scores, self.ends
        path = [0]
        node = 0
        for depth, character in enumerate(token, 1):
            child = children.get((node, character))
            if child is None:
                # the last piece of the prefix is one of those that end here
                score = scores.get(character)
                if score is None:
                    found, n = best[node] + self.unknown, tokens[node] + len(character.encode("utf-8"))
                else:
                    found, n = best[node] + score, tokens[node] + 1
                for length in ends.get(token[depth - 2 : depth], ()) if depth > 1 else ():
                    if length > depth:
                        break
                    score = scores.get(token[depth - length : depth])
                    if score is not None:
                        start = path[depth - length]
                        score += best[start]
                        if score > found or (score == found and tokens[start] + 1 < n):
                            found, n = score, tokens[start] + 1
                child = children[node, character] = len(best)
                best.append(found)
                tokens.append(n)
            path.append(child)
            node = child
        return tokens[node]

    def learn(self, found: Iterable[str]) -> None:
        if len(self.best) > _MAX_NODES:
            self.clear()
        for token in sorted(t for t in found if t not in self.counts):
            self.counts[token] = self.insert(token)


@lru_cache(maxsize=2)
def _trie(path: str) -> Trie:
    return Trie(unigram_scores(path))


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, cut = _trie(path), pieces(path).parts
        for batch in batches:
            texts = [cut(t) for t in as_texts(batch.column("text"))]
            trie.learn(set().union(*texts))
            counts = trie.counts
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([sum([counts[p] for p in t]) for t in texts], pa.int64()),
                ],
                ["row", "n_pretokens", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """The columns `keep` of each row of `docs` (text), n_pretokens and n_tokens.

    Null and empty texts have none. Rows are independent: repeated rows give repeated results. Other
    columns are left out; a column of `keep` with the name of a count gives way to it.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("row"), "text")
    kind = rows.schema["row"].dataType.simpleString()
    done = rows.mapInArrow(_count(path), f"row {kind}, n_pretokens long, n_tokens long")
    names = ("n_pretokens", "n_tokens")
    return done.select(*(f"row.{c}" for c in keep if c not in names), *names)
