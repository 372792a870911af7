"""Secret scan, token counts, packing and mixing against plain versions."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from staymart.llm import mixing, packing, secrets, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# --- secrets -----------------------------------------------------------------

KEY = "AKIA" + "ABCDEFGH12345678"
TEXT = f'naïve 😀\nToken: "abcdefghijkl"\npassword=short\n{KEY}\nAKIASHORT\n0123456789abcdef0 deadbeef\nAPI_KEY = zzzzzzzzzzzzzz'


def slow_base(text):
    found = []
    pattern = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(pattern, text, re.I | re.A):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


@pytest.mark.parametrize("text", [TEXT, "", "token=token=abcdefghijklmnop", "ſecret=abcdefghijklmn", "a" * 40 + "AKIA" * 9])
def test_base_spans(text):
    n = secrets.secrets_of(text)
    base = slow_base(text)
    assert n[3] == hashlib.sha256(base.encode()).hexdigest()
    assert n[:3] == tuple(sum(x.startswith(k) for x in base.split(",")) for k in ("assign", "access", "hex"))
    assert set(filter(None, base.split(","))) <= set(n[4].split(","))


def spans(text):
    return [text[a:b] for a, b in sorted(secrets.literal_spans(text))]


def test_constants_reach_sensitive_names():
    assert spans('x = "q8Zr$tLw92Kp"\nclient_secret = x') == ["q8Zr$tLw92Kp"]
    assert spans('a = "q8Zr$tL"\nb = a + "w92KpXy"\ndb.adminPwd := b') == ["q8Zr$tL", "w92KpXy"]
    assert spans("passphrase: 'q8Zr$tLw92Kp'") == ["q8Zr$tLw92Kp"]
    assert spans('{"private_key" => "q8Zr$tLw92Kp"}') == ["q8Zr$tLw92Kp"]


def test_harmless_assignments_are_left_alone():
    for text in [
        'title = "q8Zr$tLw92Kp"',
        'password = "changeme-example1"',
        'password = "correct horse battery"',
        "The token: a small thing. See https://example.org/a?b=c",
        'password = ""',
        "secret",
        "a" * 5000 + " = 1",
    ]:
        assert spans(text) == [], text


def test_constants_that_grow_stay_small():
    text = 'a = "q8Zr$tLw92Kp"\n' + "".join("a = a + a\n" for _ in range(200)) + "secret = a"
    assert len(spans(text)) == 1


def test_secret_scan_of_odd_documents(odd_docs, no_docs):
    rows = secrets.secret_scan(odd_docs.withColumn("spans", F.lit(1))).collect()
    assert len(rows) == 9
    assert {r.spans for r in rows if r.doc_id in (None, 1, 2)} == {""}
    assert secrets.secret_scan(no_docs).collect() == []


# --- token counts ------------------------------------------------------------


def slow_count(word, pieces, byte_score):
    best = [(0.0, 0)] + [None] * len(word)
    for j in range(1, len(word) + 1):
        ways = []
        for i in range(max(0, j - token_counts.LONGEST_PIECE), j):
            if word[i:j] in pieces:
                ways.append((best[i][0] + pieces[word[i:j]], best[i][1] + 1))
        if word[j - 1] not in pieces:
            n = len(word[j - 1].encode())
            ways.append((best[j - 1][0] + n * byte_score, best[j - 1][1] + n))
        top = max(w[0] for w in ways)
        best[j] = (top, min(w[1] for w in ways if w[0] == top))
    return best[-1]


def test_trie_counts_equal_a_word_by_word_count():
    pieces, byte_score = token_counts.zipf_pieces(PIECES)
    rng = random.Random(1)
    words = ["the", "there", "theremin", "internationalisation", "日本語", "x" * 300, "é😀\x00", "", "antidisestablishment"]
    words += ["".join(rng.choice("abcdeéè ñ▁日") for _ in range(rng.randrange(20))) for _ in range(300)]
    words = sorted({token_counts.MARK + w for w in words})
    tokens, scores = token_counts.counted(words, token_counts.Vocabulary(pieces, byte_score))
    for word, n, score in zip(words, tokens, scores):
        wanted = slow_count(word, pieces, byte_score)
        assert (n, score) == (wanted[1], wanted[0]), word


def test_token_counts_of_odd_documents(odd_docs, no_docs):
    rows = token_counts.token_counts(odd_docs.withColumn("n_tokens", F.lit(1)), PIECES).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 9
    assert (by[1].n_words, by[1].n_tokens, by[1].log_prob) == (0, 0, 0.0)
    assert by[3].n_words == 30_000 and by[3].n_tokens % 30_000 == 0
    assert token_counts.token_counts(no_docs, PIECES).collect() == []


# --- packing -----------------------------------------------------------------

WHITE = ["", " ", "  ", "a  b", " a", "a ", "a\n b", "a \nb", "it's  the\t end ", "日本 語  x", "a\x1cb c", "a\x85 b", "é　 d'll", "x <|endoftext|> y", "\n\n a"]


def test_ids_equal_the_tokenizer():
    encoder, own = Tokenizer.from_file(BPE), packing.tokens(BPE)
    rng = random.Random(2)
    texts = WHITE + ["".join(rng.choice("ab '\n\t.1é日\x1c\xa0") for _ in range(40)) for _ in range(400)]
    for text in texts:
        ids = np.frombuffer(own.of(text), "<u4").tolist()
        assert ids == encoder.encode(text, add_special_tokens=False).ids, repr(text)


def test_cuts_are_powers_of_two_without_gaps():
    for n in [*range(1, 70), 2047, 2048, 2049, 100_000]:
        parts = packing.cuts(n, 16 if n < 70 else 2048)
        assert all(size & (size - 1) == 0 for _, size in parts)
        assert [a for a, _ in parts] == [sum(s for _, s in parts[:i]) for i in range(len(parts))]
        assert sum(size for _, size in parts) == n


def test_pieces_round_trip(odd_docs, no_docs, tmp_path):
    encoder = Tokenizer.from_file(BPE)
    packed = packing.pieces(odd_docs.withColumn("length", F.lit(1)), BPE)
    rows = packed.collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert {r.offset for r in rows} == {0}
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    wanted = {}
    for r in odd_docs.collect():
        ids = encoder.encode(r.text or "", add_special_tokens=False).ids + [1]
        wanted.setdefault(r.doc_id, []).append(np.array(ids, "<u4").tobytes())
    for doc, texts in wanted.items():
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start)
        assert {r.doc_tokens for r in own} <= {len(t) // 4 for t in texts}
        if len(texts) == 1:
            assert b"".join(bytes(r.ids) for r in own) == texts[0]
    assert packing.pieces(no_docs, BPE).collect() == []
    packing.write_buckets(packed, str(tmp_path / "packed"))
    again = odd_docs.sparkSession.read.parquet(str(tmp_path / "packed"))
    assert again.where("length <> shiftleft(1, bucket)").count() == 0 and again.count() == len(rows)
    with pytest.raises(ValueError):
        packing.pieces(odd_docs, BPE, longest=1000)


# --- mixing ------------------------------------------------------------------


def slow_targets(sizes):
    """Source -> target, by sharing out the excess until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped, left = {}, float(sum(sizes.values()))
    while True:
        rest = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        for s in over:
            capped[s] = 3.0 * sizes[s]
            left -= capped[s]


def mixed_docs(make_docs, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        source = rng.choice(["b", "a", "c", None, "", "rare", "big", "big", "big", "big"])
        if source == "rare" and rng.random() < 0.95:
            source = "big"
        rows.append((i, " ".join(["w"] * rng.randrange(0, 200)), "en", source))
    rows += [(None, "w w w", "en", "a"), (5, "w", "en", "a"), (5, "w", "en", "a"), (999, None, "en", "nothing")]
    return make_docs(rows)


def test_targets_and_words_taken(make_docs):
    docs = mixed_docs(make_docs)
    rows = mixing.mixture(docs.withColumn("size", F.lit(1)), slot_rows=20).collect()
    assert len(rows) == docs.count()
    source_of = {r.doc_id: r.source for r in docs.collect() if r.doc_id not in (None, 5)}
    sizes, goal, taken, largest = {}, {}, {}, {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    wanted = slow_targets(sizes)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        if r.doc_id in source_of:
            s = source_of[r.doc_id]
            assert r.source_size == sizes[s] and abs(r.target - wanted[s]) < 1e-6 * max(1, wanted[s])
            goal[s] = r.target
            taken[s] = taken.get(s, 0) + r.taken
            largest[s] = max(largest.get(s, 0), r.size)
    assert wanted["rare"] == 3 * sizes["rare"]  # this one is capped
    for s in goal:
        assert abs(taken[s] - goal[s]) <= 2 * largest[s] + 10, s
    again = mixing.mixture(docs.repartition(7), slot_rows=20).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(key, again)) == sorted(map(key, rows))


def test_mixture_equals_sql(make_docs, tmp_path):
    docs = mixed_docs(make_docs, 2).where("doc_id <> 5")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    ours = mixing.mixture(docs).select("doc_id", "size", "source_size", "target", "taken", "copies").collect()
    assert sorted(map(tuple, ours)) == sorted(db.execute(mixing.MIXTURE_SQL).fetchall())


def test_mixture_reads_the_sizes_once_for_counts_and_once_for_ranks(make_docs, tmp_path):
    docs = make_docs([(i, "a " * (i % 50), "en", f"s{i % 3}") for i in range(300)])
    plan = mixing.mixture(docs, folder=f"file:{tmp_path}")._jdf.queryExecution().optimizedPlan()

    def scans(node):
        below = [scans(node.children().apply(i)) for i in range(node.children().size())]
        return sum(below, []) or [{node.output().apply(i).name() for i in range(node.output().size())}]

    assert sum("doc_id" in names or "source" in names for names in scans(plan)) == 1


def test_mixing_odd_documents(odd_docs, no_docs):
    assert mixing.mixture(odd_docs).count() == 9
    assert mixing.mixture(no_docs).collect() == []
    repeated = mixing.repeated(odd_docs.withColumn("copies", F.lit("clash")))
    assert repeated.columns == [*odd_docs.columns, "copies"]
    wanted = sum(r.copies for r in mixing.mixture(odd_docs).collect())
    assert abs(repeated.count() - wanted) <= 4  # ties of size are broken by row there
    empty = odd_docs.where("doc_id = 1")
    assert {r.target for r in mixing.mixture(empty).collect()} == {0.0}
