"""Secrets under long names, in many parts, and in typed declarations."""

import random
import re
import time

from staymart.llm import secrets


def spans(text):
    return [text[a:b] for a, b in sorted(secrets.literal_spans(text))]


def test_long_and_aligned_names():
    name = "com.example.platform.services." + "billing." * 9 + "credentials"
    assert len(name) > 100
    assert spans(f'{name} = "q8Zr$tLw92Kp"') == ["q8Zr$tLw92Kp"]
    assert spans("passphrase" + " " * 150 + '= "q8Zr$tLw92Kp"') == ["q8Zr$tLw92Kp"]


def test_all_parts_of_a_long_concatenation():
    parts = [f"q8Zr$tLw{i}" for i in range(200)]
    text = "x = " + " + ".join(f'"{p}"' for p in parts) + "\nclient_secret = x"
    assert spans(text) == parts


def test_typed_declarations():
    for text in [
        'db_pwd: str = "hunter2Xyz9Q!"',
        'const apiKey: string = "hunter2Xyz9Q!"',
        'def f(pwd: Optional[Dict[str, int]]="hunter2Xyz9Q!"):',
        'let secret: string | null = "hunter2Xyz9Q!";',
        'x = "hunter2Xyz9Q!"\nval password: String = x',
    ]:
        assert spans(text) == ["hunter2Xyz9Q!"], text
    assert spans("passphrase: q8ZrtLw92Kp=") == ["q8ZrtLw92Kp="]
    assert spans('{"passphrase": hunter2Xyz9Q, "b": 1}') == ["hunter2Xyz9Q"]


def test_cost_stays_linear():
    start = time.time()
    for text in ["a" * 400_000, "a:" * 200_000, "a:b[" * 100_000, "a:b<b|" * 60_000, "a " * 200_000, "a: b | " * 60_000, "a" + " " * 400_000]:
        secrets.literal_spans(text + " = 1")
    secrets.literal_spans("a0 = 'x'\n" + "".join(f"a{i + 1} = a{i} + a{i}\n" for i in range(20_000)) + "secret = a20000")
    assert time.time() - start < 30


def one_name_many_constants(n):
    """A constant of ``n`` parts that reaches ``n`` names, each with a part of its own."""
    text = "c = " + " + ".join(f"'q8Zr$tLw{i}'" for i in range(n)) + "\n"
    return text + "".join(f"user_token{i} = c\nauth_token{i} = c + 'zW3$kP0q{i}'\n" for i in range(n))


def alternating(n):
    return "".join(f"password = abcdefghijkl{i}\npassphrase = 'q8Zr$tLw92{i}'\n" for i in range(n))


def counted(monkeypatch, text):
    """How often looks are put together and values gone through."""
    steps = [0]

    def merged(one, other, real=secrets.merged):
        steps[0] += 1
        return real(one, other)

    class Counting(secrets.Value):
        __slots__ = ()

        def __getattribute__(self, name):
            if name == "parts":
                steps[0] += 1
            return super().__getattribute__(name)

    with monkeypatch.context() as patch:
        patch.setattr(secrets, "merged", merged)
        patch.setattr(secrets, "Value", Counting)
        secrets.literal_spans(text)
    return steps[0]


def test_steps_grow_with_the_text(monkeypatch):
    for make in (one_name_many_constants, alternating):
        few, many = counted(monkeypatch, make(200)), counted(monkeypatch, make(800))
        assert many < 5 * few


def test_large_texts_of_many_assignments():
    start = time.time()
    n, _, _, _, _, more = secrets.secrets_of(alternating(60_000))  # 4.7 MB
    assert (n, more) == (60_000, 60_000)
    assert len(secrets.literal_spans(one_name_many_constants(10_000))) == 20_000
    assert time.time() - start < 60


def slow_literals(text):
    """Constants written out as lists of literals, spans compared with every base span."""
    constants, found = {}, set()
    for name, parts in secrets.assignments(text):
        pieces = []
        for start, end, word, identifier in parts:
            pieces += constants[word] if identifier and word in constants else [(start, end, word)]
        constants[name] = pieces
        whole = "".join(p[2] for p in pieces)
        plain = not any(re.search(r"\s", p[2]) or secrets.PLACEHOLDER.search(p[2]) for p in pieces)
        score = secrets.name_score(name)
        if score >= 2.5 and score + secrets.Look(secrets.Counter(whole), plain).score() >= secrets.LEAST_SCORE:
            found |= {(a, b) for a, b, _ in pieces if b > a}
    base = secrets.base_spans(text)
    return {(a, b) for a, b in found if not any(a < e and s < b for s, _, e in base)}


def test_literals_equal_a_slow_version():
    rng = random.Random(8)
    names = ["a", "b", "host", "token", "db_pwd", "apiKey", "secret", "passphrase", "x.private_key"]
    values = ["'q8Zr$tLw92Kp'", '"hunter2Xyz"', "abcdefghijklmn123", "'a b'", "'changeme'", "42", "''", "deadbeefdeadbeef01"]
    for _ in range(300):
        rows = []
        for _ in range(rng.randrange(12)):
            parts = " + ".join(rng.choice(names[:4] + values) for _ in range(rng.randint(1, 3)))
            rows.append(f"{rng.choice(names)} {rng.choice('=:')} {parts}")
        text = "\n".join(rows)
        spans = secrets.literal_spans(text)
        assert set(secrets.apart(spans, secrets.base_spans(text))) == slow_literals(text), text
