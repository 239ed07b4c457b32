import hashlib
import random
from collections import Counter

from rasterloom.llm import suffix_dedup as sd


def brute(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((sum(gone), runs, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return out


def corpus(seed, n=40, alphabet="abcdefgh", passages=4):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    shared = [word(rng.randint(60, 200)) for _ in range(passages)]
    out = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(1, 5)):
            piece = rng.choice(shared) if rng.random() < 0.6 else word(rng.randint(1, 90))
            a, b = sorted((rng.randrange(len(piece) + 1), rng.randrange(len(piece) + 1)))
            text += piece if rng.random() < 0.4 else piece[a:b]
        out.append(text)
    return [*out, out[0], "ab" * 120, "a" * 150, "b" + "a" * 70]


def check(docs_of, texts, length, **more):
    rows = [(k, t) for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in sd.suffix_dedup(docs_of(rows), length=length, **more).collect()}
    want = brute([t.encode() for t in texts], length)
    for k, (n, runs, kept) in enumerate(want):
        r = got[k]
        assert (sum(s.end - s.start for s in r.removed_spans), len(r.removed_spans), bytes(r.kept)) == (n, runs, kept), k
    return got


def test_equals_brute_force(docs_of):
    check(docs_of, corpus(1), 50)
    check(docs_of, corpus(2, alphabet="ab", passages=2), 40)
    check(docs_of, corpus(3, n=60), 64, block_rows=3)


def test_many_rows_of_one_id_and_text(docs_of):
    rng = random.Random(12)
    word = lambda k: "".join(rng.choice("abcdefghij") for _ in range(k))
    long, other = word(600), word(300)
    rows = [(None, long)] * 3000 + [(1, long[:450] + other), (2, other + long[150:]), (3, word(700))]
    want = brute([t.encode() for _, t in rows[2990:]], 400)  # ten copies do as well as 3000
    assert want[-2][2] != rows[-2][1].encode() and want[-1][0] == 0
    out = sd.suffix_dedup(docs_of(rows)).select("doc_id", "kept").collect()
    assert sorted((str(r.doc_id), bytes(r.kept)) for r in out) == sorted([("None", b"")] * 3000 + [(str(k), w[2]) for k, w in zip((1, 2, 3), want[-3:], strict=True)])


def test_context_digests_are_of_the_bytes():
    data = bytes(random.Random(2).choices(b"abcd", k=3000))
    runs = list(zip(*sd.anchors(data, 400), strict=True))
    digest = {}
    for at, lo, hi, _, whole, seal in runs:
        context = (data[lo : hi + 400], at - lo)
        assert digest.setdefault((int(whole), int(seal)), context) == context
    changed = bytearray(data)
    changed[1500] ^= 1
    here = lambda r: r[1] <= 1500 < r[2] + 400
    assert not {r[4:] for r in runs if here(r)} & {r[4:] for r in zip(*sd.anchors(bytes(changed), 400), strict=True)}


def test_nulls_short_texts_repeats_and_clashing_columns(docs_of):
    long = "".join(random.Random(9).choice("abcdefghij") for _ in range(700))
    rows = [(1, None), (2, ""), (3, "short"), (4, long), (4, long), (None, "x" + long[100:650]), (5, "é" * 300), (6, "é" * 200)]
    out = sd.suffix_dedup(docs_of(rows, "kept starts _key _out _starts key")).collect()
    at = {r.doc_id: r for r in out}
    assert len(out) == 8 and at[1].n_bytes == 0 and at[3]["_kept"] == b"short" and at[3].kept == "mine"
    assert all(r["_kept"] == b"" for r in out if r.doc_id in (4, 5, 6)) and bytes(at[None]["_kept"]) == b"x"
    assert sd.suffix_dedup(docs_of([])).count() == 0


def test_multikey_sort_and_prefixes():
    rng = random.Random(4)
    words = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 60))) for _ in range(500)] + [b"a" * 100] * 30
    assert [words[i] for i in sd.multikey_sort(words)] == sorted(words)
    for _ in range(300):
        a, b = rng.choice(words), rng.choice(words)
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert sd.shared_prefix(a, b) == n


def test_anchors_of_equal_strings_agree():
    rng = random.Random(6)
    shared = bytes(rng.choice(b"abcd") for _ in range(900))
    one, two = b"zz" + shared, bytes(rng.choice(b"abcd") for _ in range(333)) + shared
    place = lambda data: {p: at - p for at, lo, hi in zip(*sd.anchors(data, 400)[:3], strict=True) for p in range(lo, hi + 1)}
    a, b = place(one), place(two)
    assert all(a[2 + k] == b[333 + k] for k in range(501)) and sorted(a) == list(range(len(one) - 399))
    assert hashlib.sha256(one).digest()
