"""A vocabulary with pieces of more than 16 characters keeps them."""

import sentencepiece

from staymart.llm import token_counts


class Model:
    def __init__(self, model_file):
        self.pieces = ["▁", "a", "▁" + "a" * 40]

    def get_piece_size(self):
        return len(self.pieces)

    def id_to_piece(self, i):
        return self.pieces[i]

    def is_unknown(self, i):
        return False

    is_control = is_byte = is_unused = is_unknown


def test_long_pieces_count(monkeypatch):
    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Model)
    counter = token_counts.Counter("any")
    assert [x[:2] for x in counter.of(["a" * 40, "a" * 41, "aa"])] == [(1, 1), (1, 2), (1, 3)]
