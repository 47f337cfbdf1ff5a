import random

import pytest

#: Extra columns named like the operators' own.
CLASHING = ["block", "fp", "row_id", "start", "words", "position", "text_hash", "size", "length", "bucket", "score", "_id", "n_words", "hashes", "v", "h"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) or (doc_id, text, source) rows, with extra columns."""
    def make(rows, extra=CLASHING):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1]), *["x"] * len(extra)) for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{n}` string" for n in extra)
        return spark.createDataFrame(full, schema)
    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Texts with everything that is awkward: nulls, empty ones, repeats, other
    spaces, marks, other alphabets, very long words and texts, shared passages."""
    rnd = random.Random(5)
    words = "the of and to Größe naïve don't x1 42 , . … über 日本語 été #tag a_b https://x.y/z ı ſ K ½ º".split()
    passage = " ".join(rnd.choice(words) for _ in range(60))
    texts = [None, "", " ", "\n\t \x0b\x0c\r", "one", "a b c", "x" * 5000, "Tab\tand  two\n\nlines\r\n end ", "'s 't 'll it's", "<|endoftext|> <|startoftext|>", "a. b.c ,d 1.2 #$ %&", "́ start"]
    for _ in range(25):
        texts.append(" ".join(rnd.choice(words) + rnd.choice(["", "", ".", ",", "s", "\n"]) for _ in range(rnd.choice([3, 12, 13, 14, 40, 120]))))
    for _ in range(8):
        a = rnd.randrange(40)
        texts.append(rnd.choice(texts[12:]) + " " + " ".join(passage.split()[a:a + 20]) + " " + str(rnd.random()))
    texts += [texts[12], texts[12], texts[20].upper(), passage, passage + " " + passage, " ".join(rnd.choice(words) for _ in range(30_000))]
    return texts


@pytest.fixture(scope="session")
def odd_rows(odd_texts):
    rows = [(i * 37 % 101, t, f"s{i % 4}") for i, t in enumerate(odd_texts)]
    return [*rows, (None, "null id here", None), (None, None, None), rows[15], rows[15], (rows[13][0], "another text of the same id", "s1")]
