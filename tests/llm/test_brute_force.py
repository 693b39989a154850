"""Language ID, decontamination and secret scan against direct forms of what they compute."""

import hashlib
import re

import numpy as np
import pytest

from crawlspark.llm import decontam, langid, secrets

DOCS = "doc_id bigint, text string, lang string, Text_Hash int, _text_hash_2 int, drawn int, share int, item_id int, words int, n_words int"


def rows_with_odd_columns(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, 4, 5, 6, 7) for row in rows], DOCS)


# --- secrets ---

PATTERNS = {
    "assign": re.compile("((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}
GOOD = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}


def base_of(text):
    return sorted((m.start(), m.end(), kind) for kind, pattern in PATTERNS.items()
                  for m in pattern.finditer(text) if GOOD[kind](m))


def secret_texts(count):
    rng = np.random.default_rng(7)
    parts = ["password", "Passwd", "SECRET", "toKen", "toKen", "api_key", "apikey", "API_KEY", "AKIA", "akia", "AKIAAKIA", "=", ":",
             " ", "  ", "\"", "'", "x", "abc/+", "ABCDEFGHIJ0123456", "0123456789abcdef", "deadbeef", "İ", "é", "\n", ".", "_", "-",
             "ghp_", "Z" * 30]
    return [None, "", *("".join(rng.choice(parts, rng.integers(1, 40))) for _ in range(count))]


def test_base_secrets_are_those_of_the_patterns():
    words = secrets.automaton()
    for text in secret_texts(6000):
        found = [span for span in secrets.scan((text or "").encode(), words) if span[2] in PATTERNS]
        assert sorted(found) == base_of(text or ""), text


def test_secret_rows_carry_counts_and_digest(spark):
    texts = secret_texts(60) + ["é" * 300_000 + " token=abcdefgh " + "0123456789abcdef" * 20_000]
    docs = rows_with_odd_columns(spark, [(n % 50, text, None) for n, text in enumerate(texts)] + [(None, "token=abcdefgh", None)])
    expected = []
    for doc_id, text in [(n % 50, text) for n, text in enumerate(texts)] + [(None, "token=abcdefgh")]:
        base = sorted(base_of(text or ""), key=lambda span: (span[0], list(PATTERNS).index(span[2])))
        listed = ",".join(f"{kind}:{start}:{end}" for start, end, kind in base)
        expected.append((doc_id, *(sum(span[2] == kind for span in base) for kind in PATTERNS),
                         hashlib.sha256(listed.encode()).hexdigest()))
    found = [tuple(row)[:5] for row in secrets.find_secrets(docs).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


# --- decontamination ---

def folded(text):
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", (text or "").casefold())


def agreeing_words(words, item):
    """Words of the item that agree within any overlap with the text: every alignment is tried."""
    width = decontam.LEAST if len(item) >= decontam.LEAST else len(item)
    errors = 2 if len(item) >= 13 else int(len(item) >= 8)
    inside = set()
    for own in range(len(item) - width + 1 if item else 0):
        for start in range(len(words) - width + 1):
            same = [item[own + step] == words[start + step] for step in range(width)]
            if width - sum(same) <= errors:
                inside |= {own + step for step in range(width) if same[step]}
    return len(inside)


def decontamination_case():
    rng = np.random.default_rng(5)
    word = lambda count: [f"W{n}" for n in rng.integers(0, 400, count)]
    items = [word(size) for size in (1, 2, 5, 7, 8, 9, 12, 13, 14, 20, 30)] + [["x"], [], ["É", "ß", "Σ"]]
    texts = []
    for _ in range(50):
        text = word(rng.integers(0, 30))
        for place in rng.integers(0, len(items), 2):
            piece = list(items[place])
            for _ in range(rng.integers(0, 4)):
                if piece:
                    piece[rng.integers(0, len(piece))] = "other"
            text += piece[rng.integers(0, 3):] + word(rng.integers(0, 5))
        texts.append(", ".join(text).lower())
    texts += [None, "", " ,;", "é ss σ"]
    return items, texts


def test_overlaps_are_those_of_all_alignments(spark, monkeypatch):
    items, texts = decontamination_case()
    table = spark.createDataFrame([(n, " ".join(item)) for n, item in enumerate(items)] + [(90, None), (None, "w1")],
                                  "item_id bigint, text string")
    # Two texts share every tenth doc_id; some rows have none.
    ids = [None if n % 13 == 12 else n - (n % 10 == 9) for n in range(len(texts))]
    docs = rows_with_odd_columns(spark, [(doc_id, text, None) for doc_id, text in zip(ids, texts)])
    expected, dirty = {}, set()
    for place, (doc_id, text) in enumerate(zip(ids, texts)):
        for item_id, item in enumerate(items):
            agree = agreeing_words(folded(text), folded(" ".join(item)))
            if agree:
                dirty.add(place)
                if doc_id is not None:
                    own = expected.setdefault(doc_id, {})
                    own[item_id] = max(own.get(item_id, 0), agree)
    for block in (500_000, 40):
        found = {row.doc_id: (row.n_items, row.n_words, row["items"]) for row in decontam.contaminated(docs, table, block).collect()}
        assert found == {doc_id: (len(own), sum(own.values()), ",".join(map(str, sorted(own)))) for doc_id, own in expected.items()}
    left = decontam.remove_contaminated(docs, table)
    assert left.columns == docs.columns
    clean = [(ids[n], texts[n], None, 1, 2, 3, 4, 5, 6, 7) for n in range(len(texts)) if n not in dirty]
    assert 0 < len(clean) < len(texts) and sorted(map(tuple, left.collect()), key=str) == sorted(clean, key=str)
    assert decontam.remove_contaminated(docs.limit(0), table).collect() == []
    assert decontam.contaminated(docs.limit(0), table).collect() == []


@pytest.mark.parametrize("piece", [1, 5, 16])
def test_overlaps_across_the_seams_of_pieces(monkeypatch, piece):
    items, texts = decontamination_case()
    searched = decontam.Items([(n, " ".join(item).encode()) for n, item in enumerate(items)])
    monkeypatch.setattr(decontam, "PIECE", piece)
    for text in texts:
        agree = {n: agreeing_words(folded(text), folded(" ".join(item))) for n, item in enumerate(items)}
        assert searched.overlaps((text or "").encode()) == {n: count for n, count in agree.items() if count}


# --- language ID ---

def bucket(gram):
    return ((int.from_bytes(gram, "big") + len(gram)) * 0x9E3779B97F4A7C15 % (1 << 64)) >> 51


def counts_of(text):
    letters = bytes(code if 97 <= code <= 122 or code >= 128 else 32 for code in b" " + text.lower().encode())
    counts = np.zeros(langid.BUCKETS, np.int64)
    for order in langid.ORDERS:
        for start in range(len(letters) - order + 1):
            if letters[start:start + order] != b" " * order:
                counts[bucket(letters[start:start + order])] += 1
    return counts


def test_subwords_are_those_of_the_definition(monkeypatch):
    for text in ("", " ", "a", "Über  die Brücke, 12 Ñandú!", "x" * 70, "Σίσυφος 中文 abc" * 9):
        for piece in (1 << 16, 8):
            monkeypatch.setattr(langid, "PIECE", piece)
            assert (langid.subword_counts(text.encode()) == counts_of(text)).all()


def test_scores_are_a_softmax_of_the_mean_embedding():
    rng = np.random.default_rng(2)
    table, bias = rng.normal(size=(langid.BUCKETS, 3)), rng.normal(size=3)
    model = langid.LanguageModel(["a", "b", "c"], table, bias, 0.7, 0.5)
    for text in ("one text", "Überall", "zzz yyy xxx"):
        counts = counts_of(text)
        weights = np.exp((counts @ table / counts.sum() + bias) / 0.7)
        lang, score, rejected = model.predict(text.encode())
        assert lang == "abc"[weights.argmax()] and rejected == (score < 0.5)
        assert score == pytest.approx(weights.max() / weights.sum())
    assert model.predict("12 ,!".encode()) == ("und", 0.0, True)


def test_gradient_steps_follow_the_loss(monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(40, 6, replace=False)) + 100 * (n % 2), rng.integers(1, 5, 6)) for n in range(70)]
    sample, labels, used = langid.Sample(rows), np.arange(70) % 2, np.arange(70)
    seen = []
    original = langid.Sample.shares
    monkeypatch.setattr(langid.Sample, "shares", lambda self, batch: seen.append(batch.tolist()) or original(self, batch))
    table, bias = langid._descend(sample, labels, used, 2, 4, 2.0, np.random.default_rng(1))
    epochs = [sum(seen[start:start + 3], []) for start in range(0, len(seen), 3)]
    assert len(epochs) == 4 and all(sorted(epoch) == list(range(70)) for epoch in epochs)
    assert len({tuple(epoch) for epoch in epochs}) == 4
    assert (sample.scores(used, table, bias).argmax(axis=1) == labels).all()


def test_one_batch_is_one_gradient_step():
    rng = np.random.default_rng(4)
    rows = [(np.arange(n, n + 5), rng.integers(1, 5, 5)) for n in range(6)]
    sample, labels, used = langid.Sample(rows), np.arange(6) % 2, np.arange(6)
    draw = np.random.default_rng(9)
    embed, weight = draw.normal(0, 0.1, (langid.BUCKETS, langid.DIMENSIONS)), draw.normal(0, 0.1, (langid.DIMENSIONS, 2))
    inputs, gold = sample.shares(used), np.eye(2)[labels]

    def loss(embed, weight):
        scores = inputs @ embed @ weight
        return -(gold * (scores - np.log(np.exp(scores).sum(axis=1, keepdims=True)))).sum() / 6

    table, _ = langid._descend(sample, labels, used, 2, 1, 0.001, np.random.default_rng(9))
    step = table - embed @ weight
    # To first order the table moves by what either factor's numerical gradient says; embeddings take 50 times the step.
    to_weight, to_embed = np.zeros_like(weight), np.zeros((20, langid.DIMENSIONS))
    for place in np.ndindex(weight.shape):
        moved = weight.copy()
        moved[place] += 1e-5
        to_weight[place] = (loss(embed, moved) - loss(embed, weight)) / 1e-5
    for place in np.ndindex(to_embed.shape):
        moved = embed.copy()
        moved[place] += 1e-5
        to_embed[place] = (loss(moved, weight) - loss(embed, weight)) / 1e-5
    expected = -0.001 * (embed[:20] @ to_weight + 50 * to_embed @ weight)
    assert np.allclose(step[:20], expected, rtol=0.02, atol=1e-7)


def test_many_languages_and_rows_without_doc_id_are_learned(spark):
    rng = np.random.default_rng(6)
    words = {n: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)] for n in range(260)}
    rows = [(None, " ".join(rng.choice(words[n], 30)), f"l{n:03d}") for n in range(260) for _ in range(20)]
    rows += [rows[0]] * 500 + [(1, None, "l000"), (2, "text", None)]
    docs = rows_with_odd_columns(spark, rows)
    model = langid.train(docs)
    assert len(model.languages) == 260
    right = [model.predict(text.encode())[0] == lang for _, text, lang in rows[:5200]]
    assert np.mean(right) > 0.9
    # The bound on rows holds for all languages together; no language goes below its least share.
    bounded = langid.train(docs.where("lang in ('l000', 'l001')"), most_rows=40)
    assert bounded.languages == ["l000", "l001"]
    assert langid.train(docs, most_rows=60).languages == ["l000", "l001", "l002"]
