import random

from rasterloom.llm.line_dedup import line_dedup


def brute(rows, size=3):
    seen, out = {}, {}
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        lines = text.split("\n")
        gone = set()
        for p in range(len(lines) - size + 1):
            w = tuple(lines[p : p + size])
            if seen.setdefault(w, (key, p)) != (key, p):
                gone |= set(range(p, p + size))
        out[key] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_equals_brute_force(docs_of):
    rng = random.Random(1)
    rows = [(k, "\n".join(rng.choice("abcd") for _ in range(rng.randint(0, 14)))) for k in range(120)]
    got = {r.doc_id: r for r in line_dedup(docs_of(rows)).collect()}
    want = brute(rows)
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_lines == len(t.split("\n")) for (k, t) in rows for r in [got[k]])


def test_nulls_ties_repeats_long_texts_and_clashing_columns(docs_of):
    long = "\n".join(str(k) for k in range(50_000))
    rows = [(1, None), (None, "a\nb\nc"), (2, "a\nb\nc\nd"), (2, "a\nb\nc\nd"), (3, ""), (4, long), (5, long + "\nnew"), (6, "x\nx\nx\nx\nx")]
    out = line_dedup(docs_of(rows, "n_lines id dedup_starts lines")).collect()
    at = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and at[1].text is None and at[1]["_n_lines"] == 0 and at[1].n_lines == "mine"
    assert at[None].text == "a\nb\nc" and [r.text for r in out if r.doc_id == 2] == ["d", "d"]
    assert at[3].text == "" and at[4].n_removed == 0 and at[5].text == "new" and at[6].text == "x"


def test_empty_table(docs_of):
    assert line_dedup(docs_of([])).count() == 0
