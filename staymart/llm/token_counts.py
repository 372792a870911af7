"""Token counts of a unigram model by dynamic programming over a trie.

A text is cut at white space into pre-tokens, each led by the word mark. Pre-tokens not seen
before are put into a trie, level by level. Forward scores, the best log probability of any
split of a prefix into pieces and the tokens it takes, are computed once per trie node, so
once per shared prefix; the nodes where pre-tokens end give their counts. Pieces that end
at a node are followed as states of a trie of the vocabulary, one per start.

The vocabulary is a ``sentencepiece`` file. Its ids go by rank, from which Zipf's law gives
the probabilities: nothing is trained. Letters without a piece cost a token per byte.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from staymart.llm.common import scan

MARK = "▁"
#: Words remembered in a Python worker; the first ones, the common ones are among them.
MOST_KNOWN = 600_000
#: The longest piece of the registered vocabulary; other files may hold longer ones.
LONGEST_PIECE = 16
CODE_SPAN = 1 << 21
MANY = np.iinfo(np.int64).max // 4


class Vocabulary:
    """Pieces as a trie: sorted (state, code point) pairs and the score of each state."""

    def __init__(self, pieces: dict[str, float], byte_score: float) -> None:
        self.byte_score = byte_score
        edges: dict[tuple[int, int], int] = {}
        scores = [-np.inf]
        for piece, score in pieces.items():
            state = 0
            for c in map(ord, piece):
                state = edges.setdefault((state, c), len(scores))
                if state == len(scores):
                    scores.append(-np.inf)
            scores[state] = score
        keys = np.array([s * CODE_SPAN + c for s, c in edges], np.int64)
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.array(list(edges.values()), np.int64)[order]
        self.scores = np.array(scores)
        self.width = max(map(len, pieces), default=1)

    def follow(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        wanted = states * CODE_SPAN + codes
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.to[at], -1)


def zipf_pieces(path: str) -> tuple[dict[str, float], float]:
    """Log probabilities by rank, and that of a byte, the rarest of all."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
    ]
    norm = float(np.log(sum(1 / (r + 2) for r in range(len(usual) + 1))))
    scores = {p: -float(np.log(r + 2)) - norm for r, p in enumerate(usual) if p}
    return scores, -float(np.log(len(usual) + 2)) - norm


def counted(words: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and scores of distinct words, by one pass over the trie that they form.

    Of splits with the same score the one of fewest tokens counts.
    """
    n, width = len(words), vocabulary.width
    lengths = np.fromiter(map(len, words), np.int64, n)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    tokens, scores = np.zeros(n, np.int64), np.zeros(n)
    # of each node of the last level: states of open pieces, and score and tokens where they began
    states = np.full((1, width), -1, np.int64)
    forward, taken = np.full((1, width), -np.inf), np.zeros((1, width), np.int64)
    best, count = np.zeros(1), np.zeros(1, np.int64)
    live, node, depth = np.arange(n), np.zeros(n, np.int64), 0
    while True:
        ended = lengths[live] == depth
        tokens[live[ended]], scores[live[ended]] = count[node[ended]], best[node[ended]]
        live, node = live[~ended], node[~ended]
        if not len(live):
            return tokens, scores
        pair = node * CODE_SPAN + codes[begin[live] + depth]
        nodes, node = np.unique(pair, return_inverse=True)
        node = node.reshape(-1)
        parent, code = nodes // CODE_SPAN, nodes % CODE_SPAN
        states = np.hstack([np.zeros((len(nodes), 1), np.int64), states[parent, :-1]])
        forward = np.hstack([best[parent, None], forward[parent, :-1]])
        taken = np.hstack([count[parent, None], taken[parent, :-1]])
        row, column = np.nonzero(states >= 0)
        states[row, column] = vocabulary.follow(states[row, column], code[row])
        reached = np.where(states >= 0, vocabulary.scores[np.maximum(states, 0)], -np.inf) + forward
        used = np.where(np.isfinite(reached), taken + 1, MANY)
        bare = ~np.isfinite(np.where(states[:, 0] >= 0, vocabulary.scores[np.maximum(states[:, 0], 0)], -np.inf))
        octets = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        reached[bare, 0] = forward[bare, 0] + octets[bare] * vocabulary.byte_score
        used[bare, 0] = taken[bare, 0] + octets[bare]
        best = reached.max(axis=1)
        count = np.where(reached == best[:, None], used, MANY).min(axis=1)
        depth += 1


class Counter:
    """Counts of words in one Python worker, with those found so far."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(*zipf_pieces(path))
        self.known: dict[str, tuple[int, float]] = {}

    def of(self, texts: list[str | None]) -> list[tuple[int, int, float]]:
        """Words, tokens and log probability of each text."""
        split = [split_words(x) for x in texts]
        new = sorted({w for one in split for w in one} - self.known.keys())
        tokens, scores = counted([MARK + w for w in new], self.vocabulary) if new else ([], [])
        fresh = dict(zip(new, zip(map(int, tokens), map(float, scores))))
        if len(self.known) < MOST_KNOWN:
            self.known.update(fresh)
            look = self.known.__getitem__
        else:
            look = lambda w, a=self.known, b=fresh: a[w] if w in a else b[w]
        out = []
        for one in split:
            found = list(map(look, one))
            out.append((len(one), sum(f[0] for f in found), sum(f[1] for f in found)))
        return out


def split_words(text: str | None) -> list[str]:
    data = (text or "").encode("utf-8", "surrogatepass").split()
    return [w.decode("utf-8", "surrogatepass") for w in data]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_words, n_tokens, log_prob`` per row of ``docs``.

    White space is space and code points 9 to 13. A null or empty text has 0 tokens. A word
    without white space may be as long as a text: its cost is linear. Repeated rows come back
    each, other columns do not matter, an empty table gives no rows.
    """

    def of_slice(part):
        rows = counter(vocabulary).of(part["text"])
        return {"doc_id": part["doc_id"]} | {
            k: [r[i] for r in rows] for i, k in enumerate(["n_words", "n_tokens", "log_prob"])
        }

    return scan(docs, ["doc_id", "text"], of_slice, "doc_id long, n_words long, n_tokens long, log_prob double")
