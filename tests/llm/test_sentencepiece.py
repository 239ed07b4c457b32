import hashlib
import random

import sentencepiece

from rasterloom.llm import sentencepiece_codec as sc


def test_equals_the_library_on_random_text():
    codec = sc.encoder(sc.default_model())
    library = sentencepiece.SentencePieceProcessor(model_file=sc.default_model())
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice("ab the  \n\t▁<0x>é漢字🙂\u0000in·s1234erDOC.,!") for _ in range(rng.randint(0, 40)))
        assert codec.encode(text) == [*library.encode(text), 2], repr(text)
    for n in [*range(40), 500]:
        for before in ("", "a", "\n"):
            for after in ("", "a", "the", "\n", "."):
                text = before + " " * n + after
                assert codec.encode(text) == [*library.encode(text), 2], (before, n, after)


def test_rows(docs_of):
    library = sentencepiece.SentencePieceProcessor(model_file=sc.default_model())
    texts = ["Hello world.\nAgain", "", None, "Hello world.\nAgain", "x" * 30_000 + " tail", " ".join(map(str, range(20_000)))]
    docs = docs_of(list(enumerate(texts)), "ids")
    out = sc.sentencepiece_encode(docs, with_decoded=True).collect()
    assert len(out) == len(texts) and out[0].ids == "mine"
    for r in out:
        ids = [*library.encode(texts[r.doc_id] or ""), 2]
        assert r["_ids"] == ids and r.n_tokens == len(ids) and r.decoded == library.decode(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    back = sc.sentencepiece_decode(sc.sentencepiece_encode(docs_of(list(enumerate(texts)))).select("doc_id", "ids")).collect()
    assert all(r.text == (texts[r.doc_id] or "") for r in back)
    assert sc.sentencepiece_encode(docs_of([])).count() == 0
