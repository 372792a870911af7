import random

import pytest
from pyspark.sql import functions as F

from staymart.llm import lines

BLANKS = " \t\x0b\x0c\r"


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def edited(line, n, rng, alphabet="abcdefgh é😀"):
    out = list(line)
    for _ in range(n):
        how, at = rng.random(), rng.randrange(len(out) + 1)
        if how < 0.34:
            out.insert(at, rng.choice(alphabet))
        elif out and how < 0.67:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = rng.choice(alphabet)
    return "".join(out)


def test_banded_distance_equals_the_full_table(spark):
    rng, pairs = random.Random(3), [("", ""), ("", "ab"), ("abc", ""), ("a", "abc")]
    for _ in range(500):
        a = "".join(rng.choice("abé😀 ") for _ in range(rng.randrange(30)))
        pairs.append((a, edited(a, rng.randrange(5), rng)))
    frame = spark.createDataFrame(pairs, "x string, y string").repartition(4)
    for edits in (1, 2, 3):
        for x, y, d in frame.select("x", "y", lines.banded_distance("x", "y", edits)).collect():
            assert min(d, edits + 1) == min(distance(x, y), edits + 1), (x, y)


def brute(rows):
    """(row number, line number) of every line to drop, by comparing all pairs of lines."""
    places = {}
    for n, (doc_id, text) in enumerate(rows):
        for pos, raw in enumerate((text or "").split("\n")):
            line = raw.strip(BLANKS)
            if len(line) >= lines.LEAST_CHARS:
                places.setdefault(line, []).append((doc_id is None, doc_id or 0, n, pos))
    drop, stay = [], []
    for line in sorted(places, key=lambda x: min(places[x])):  # the smallest place first
        near = any(abs(len(line) - len(x)) <= 2 and distance(line, x) <= 2 for x in stay)
        drop += sorted(places[line])[0 if near else 1 :]
        if not near:
            stay.append(line)
    return sorted((p[2], p[3]) for p in drop)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    pool = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(18, 60))) for _ in range(60)]
    rows = []
    for i in range(120):
        some = [edited(rng.choice(pool), rng.choice([0, 0, 1, 2, 3, 5]), rng) for _ in range(rng.randrange(6))]
        some += [rng.choice(["", "  ", "short", "the one line that is very common here", " the one line that is very common here\r"])]
        rng.shuffle(some)
        rows.append((i, "\n".join(some)))
    return rows + [(500, None), (501, ""), (None, rows[0][1]), (502, "x" * 5000 + "\n" + "x" * 4999 + "y")]


def test_dropped_lines_are_those_of_brute_force(spark, texts):
    frame = spark.createDataFrame([(i, t, "clash") for i, t in texts], "doc_id long, text string, row string")
    got = {r.doc_id: r for r in lines.line_report(frame).collect()}
    wanted = brute(texts)
    number = {doc_id: n for n, (doc_id, _) in enumerate(texts)}
    assert sorted((number[i], d.line) for i, r in got.items() for d in r.dropped) == wanted
    assert all(r.n_dropped == len(r.dropped) and r.n_lines == len((dict(texts)[i] or "").split("\n")) for i, r in got.items())
    kept = {(i, n) for i, t in texts for n in range(len((t or "").split("\n")))} - {(texts[a][0], b) for a, b in wanted}
    assert all((d.first_doc_id, d.first_line) in kept for r in got.values() for d in r.dropped)


def test_common_lines_are_taken_out_first(spark, texts, monkeypatch):
    monkeypatch.setattr(lines, "COMMON", 20)  # now several lines are too common
    monkeypatch.setattr(lines, "MOST_BROADCAST", 0)  # and candidates are joined
    monkeypatch.setattr(lines, "CROWD", 1)  # and a key of two lines is crowded
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = lines.line_report(frame).collect()
    number = {doc_id: n for n, (doc_id, _) in enumerate(texts)}
    assert sorted((number[r.doc_id], d.line) for r in got for d in r.dropped) == brute(texts)


def test_texts_without_their_repeats(make_docs, no_docs, texts):
    docs = make_docs([(i, t, "en", "s") for i, t in texts]).withColumn("pos", F.lit("clash"))
    out = lines.without_repeats(docs)
    assert out.columns == docs.columns
    drop = {}
    for n, pos in brute(texts):
        drop.setdefault(n, set()).add(pos)
    wanted = []
    for n, (doc_id, text) in enumerate(texts):
        if n in drop:
            text = "\n".join(x for p, x in enumerate(text.split("\n")) if p not in drop[n])
            if len(text.encode().split()) < lines.LEAST_WORDS:
                continue
        wanted.append((doc_id, text))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(r.doc_id, r.text) for r in out.collect()], key=key) == sorted(wanted, key=key)
    assert out.where("n_chars <> char_length(text)").count() == 0
    assert lines.without_repeats(no_docs).collect() == lines.line_report(no_docs).collect() == []


def test_repeated_rows_and_odd_documents(make_docs, odd_docs):
    line = "a line that is long enough to count"
    docs = make_docs([(3, line, "en", "s"), (3, line, "en", "s"), (None, line + "!", "en", "s")])
    got = sorted((r.doc_id is None, r.n_dropped) for r in lines.line_report(docs).collect())
    assert got == [(False, 0), (False, 1), (True, 1)]
    assert [r.doc_id for r in lines.without_repeats(docs).collect()] == [3]
    assert lines.line_report(odd_docs).count() == 9


def test_main_path_has_no_python(spark, texts, monkeypatch):
    """Neither in what is returned nor in any table written on the way."""
    plans = []

    def watched(real):
        def write(df, folder, name):
            plans.append(df._jdf.queryExecution().toString())
            return real(df, folder, name)

        return write

    for name in ("stage", "stage_text"):
        monkeypatch.setattr(lines, name, watched(getattr(lines, name)))
    monkeypatch.setattr(lines, "CROWD", 1)
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    plans.append(lines.line_report(frame)._jdf.queryExecution().toString())
    assert len(plans) > 15
    assert not any(word in plan for plan in plans for word in ("Python", "Pandas", "Arrow", "MapIn"))


def template_lines(n):
    """One line of a template a document, a number apart."""
    return [(i, f"request {(i * 7919) % 10**6:06d} was served by the front end without delay") for i in range(n)]


def test_template_lines_are_settled_as_by_brute_force(spark):
    rows = [(i, f"the value number {i} of this table stands here") for i in range(400)] + [(1_000 + i, t) for i, t in template_lines(300)]
    got = {r.doc_id: r for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    wanted = {rows[n][0] for n, _ in brute(rows)}
    assert {i for i, r in got.items() if r.n_dropped} == wanted and len(wanted) < 600
    text = dict(rows)
    for i, r in got.items():
        for d in r.dropped:
            assert distance(text[i], text[d.first_doc_id]) <= 2 and not got[d.first_doc_id].n_dropped


def test_middles_meet_exactly_if_near(spark):
    rng = random.Random(9)
    words = ["", "a", "ab", "ba"] + ["".join(rng.choice("abc") for _ in range(rng.randrange(7))) for _ in range(60)]
    words = sorted(set(words))
    frame = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "h int, middle string")
    met = {}
    for r in frame.select("h", F.inline(lines.variants("middle"))).collect():
        met.setdefault(r.variant, []).append((r.h, r.hub))
    pairs = {(a, b) for group in met.values() for a, x in group for b, y in group if a < b and (x or y)}
    wanted = {(a, b) for a in range(len(words)) for b in range(a + 1, len(words)) if distance(words[a], words[b]) <= 2}
    assert pairs == wanted


def test_groups_of_template_lines_grow_with_the_lines(spark, tmp_path):
    """Rows of groups, and so the work, are so many a line, not a pair."""
    sizes = {}
    for n in (2_000, 8_000):
        docs = spark.createDataFrame(template_lines(n), "doc_id long, text string").withColumn("row", F.col("doc_id"))
        held = lines.numbered_lines(docs)
        classes = held.groupBy("h1", "h2").agg(F.min(lines.place_of()).alias("first"), F.count("*").alias("n"))
        sizes[n] = lines.near_lines(held, classes, n, str(tmp_path)).count()
    assert sizes[8_000] < 6 * sizes[2_000]


def test_lines_whose_first_hash_is_shared_take_no_part(spark):
    rows = [("a line of more than twenty letters", 7, 1), ("another line of more than twenty", 7, 2), ("a third line of many letters", 8, 3)]
    held = spark.createDataFrame(rows, "line string, h1 long, h2 long")
    assert [r.h for r in lines.texts_and_marks(held, held.select("h1").distinct()).collect()] == [8]


def test_what_is_left_of_a_document_stays(make_docs):
    header = "Licensed under the terms that stand in the file"
    docs = make_docs([
        (1, header + "\nthe first document's own line of text", "en", "s"),
        (2, header + "\nA unique sentence of seven words only", "en", "s"),
        (3, header + "\nonly here", "en", "s"),
        (4, header + "\n  \t\r\n", "en", "s"),
    ])
    got = {r.doc_id: r.text for r in lines.without_repeats(docs).collect()}
    assert got.keys() == {1, 2, 3}
    assert got[2] == "A unique sentence of seven words only" and got[3] == "only here"


def test_copies_leave_no_short_lines(make_docs):
    header, body = "Licensed under the terms that stand in the file", "a body of text that only this one has"
    short = "\n".join(f"line {i} a b c" for i in range(5))  # 25 words
    docs = make_docs([
        (1, header, "en", "s"),
        (2, f"{header}\n{short}\n{body}", "en", "s"),
        (3, f"{header}\n{short}\n{body}", "en", "s"),
        (4, f"{header}\n{short}\n{body}!", "en", "s"),  # a near copy
        (5, f"{header}\n{short}\nother words\n{body}", "en", "s"),
    ])
    got = {r.doc_id: r.text for r in lines.without_repeats(docs).collect()}
    assert got == {1: header, 2: f"{short}\n{body}", 5: f"{short}\nother words"}


def test_short_repeats_are_reported(make_docs):
    docs = make_docs([(7, " usage \n\nusage\n \t", "en", "s"), (3, "one of a kind\nusage\r", "en", "s"), (None, None, "en", "s")])
    got = {r.doc_id: r for r in lines.line_report(docs).collect()}
    assert {i: (r.n_dropped, r.n_short, [tuple(x) for x in r.short]) for i, r in got.items()} == {
        7: (0, 2, [(0, 3, 1), (2, 3, 1)]),
        3: (0, 0, []),
        None: (0, 0, []),
    }


def test_hot_segments_are_dealt_over_slots(spark, tmp_path, monkeypatch):
    """Half of the lines share their start; with every line looked at its key is hot."""
    rng = random.Random(17)
    words = ["".join(rng.choice("abcdefghij") for _ in range(30)) for _ in range(40)]
    shared = ["a shared start of 30 letters : " + w[:20] for w in words]
    both = words + shared
    rows = list(enumerate(both + [edited(x, 2, rng) for x in both[::5]] + shared[3:4]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for shown in (1, 1 << 40):  # with and without hot keys
        monkeypatch.setattr(lines, "SHOWN", shown)
        folder = tmp_path / str(shown)
        got = lines.line_report(docs, str(folder)).collect()
        assert sorted((r.doc_id, d.line) for r in got for d in r.dropped) == brute(rows)
        (hot,) = folder.glob("hot-*")
        assert spark.read.parquet(str(hot)).isEmpty() == (shown > 1)


def test_keys_are_made_from_texts_and_shuffled_once(spark, texts, monkeypatch):
    plans, real = {}, lines.stage

    def watched(df, folder, name):
        df.collect()  # then the plan is the one that ran
        plans[name] = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        return real(df, folder, name)

    monkeypatch.setattr(lines, "stage", watched)
    lines.line_report(spark.createDataFrame(texts, "doc_id long, text string"))
    assert plans["probes"].count("posexplode(split(") == 1  # index keys, probes and common lines took one each
    assert plans["hot"].count("posexplode(split(") == 1


def test_keys_of_plain_lines_are_those_by_letters(spark):
    rows = ["a plain line that is long enough", "a pläin line that is long enough", "😀" * 20, "x" * 21, "é" + "x" * 21]
    frame = lines.with_bytes(spark.createDataFrame([(x,) for x in rows], "line string"))
    size = F.col("length")
    both = [f.withColumn("own", lines.index_keys(size)).withColumn("keys", lines.probe_keys(size)) for f in (frame, frame.withColumn("plain", F.lit(False)))]
    plain, slow = ([(r.line, r.own, r.keys) for r in f.collect()] for f in both)
    assert [r.plain for r in frame.collect()] == [True, False, False, True, False]
    assert plain == slow
    assert all(keys[: lines.EDITS + 1] == own for _, own, keys in plain)
