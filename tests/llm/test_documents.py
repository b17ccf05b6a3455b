"""Joins, rules, language, scores, pages, vectors, licences and the pipeline."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import content, jaccard, language, license, mixing, near_vectors, rules
from tidemark.llm import textkit as tk
from corpus_rows import DOCUMENTS, SF, rows_of

GAP = r"[\x20\x09-\x0D]+"


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(GAP, low) if w]


def components(links, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_jaccard(texts):
    sets = {}
    for i, t in enumerate(texts):
        w = words_of(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, components(links, sets)


@pytest.fixture(scope="module")
def families():
    """Families of near copies that drift apart, exact copies, short, empty and NULL texts."""
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    out = [None, "", "  ", "one two", "ONE  two", "one two three four", "one two"]
    passage = [r.choice(vocabulary) for _ in range(60)]
    for _ in range(6):
        base = [r.choice(vocabulary) for _ in range(r.randint(60, 150))]
        for _ in range(14):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            out.append(" ".join(copy if r.random() < 0.7 else copy + passage[: r.randint(0, 20)]))
        out.append(" ".join(base))
        out.append(" ".join(base).upper())
    for _ in range(20):
        out.append(" ".join([r.choice(vocabulary) for _ in range(90)] + passage))
    return out


def test_jaccard_components_equal_brute_force(spark, work, families):
    df = spark.createDataFrame(rows_of(families), DOCUMENTS).repartition(4)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(spark, df).collect()}
    sets, component = brute_jaccard(families)
    assert found == {i: (len(sets[i]), component[i]) for i in sets}


def test_jaccard_blocks_and_windows_lose_nothing(spark, work, families, monkeypatch):
    monkeypatch.setattr(jaccard, "TOGETHER", 5)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "NEAR", 1)
    df = spark.createDataFrame(rows_of(families), DOCUMENTS).repartition(4)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(spark, df).collect()}
    assert found == brute_jaccard(families)[1]


def test_jaccard_empty_table(spark, none):
    assert jaccard.jaccard_components(spark, none).count() == 0


def test_rules_equal_their_sql(spark, folder, texts, families):
    extra = ["a b c a b c", "x x x x x", "# $ <b>\nline\nline\n \nline", " ".join(["the of and to"] * 40)]
    rows = rows_of([*texts, *families, *extra])
    df = rules.apply_rules(spark.createDataFrame(rows, DOCUMENTS)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    documents = pd.DataFrame({"doc_id": [r[0] for r in rows], "text": pd.Series([r[1] for r in rows], dtype=object)})  # noqa: F841
    expected = duckdb.sql(rules.oracle()).fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(expected)


def test_slow_window_count_equals_the_quick_one(spark, families):
    df = rules.measures(spark.createDataFrame(rows_of(families), DOCUMENTS)).select("doc_id", "n_repeat_words", "text")
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), rules.GAP), "")
    slow = df.withColumn("_words", words).where(F.size("_words") > 2).select("n_repeat_words", rules._slow_repeat().alias("slow"))
    assert all(r["n_repeat_words"] == r["slow"] for r in slow.collect())


def test_language_held_out_accuracy(spark, work):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = language.remainder("doc_id", 5) == 0
    found = language.identify(docs.where(held), language.train(docs.where(~held)))
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.97 and 0 <= right[1] <= right[2] <= 1


def test_language_without_letters_or_training(spark, docs, none):
    none_known = language.identify(docs, language.train(none))
    assert {r["lang_pred"] for r in none_known.collect()} == {"und"}
    known = language.identify(spark.createDataFrame(rows_of([None, "", "12 !", "abc"]), DOCUMENTS), {"en": np.ones(language.DIMENSIONS) / 16, "de": np.ones(language.DIMENSIONS) / 16})
    assert [(r["lang_pred"], r["score"] == 0) for r in known.orderBy("doc_id").collect()][:3] == [("und", True)] * 3
    assert known.orderBy("doc_id").collect()[3]["lang_pred"] in ("de", "und")


def test_language_bundles_equal_the_definition():
    letters = language.letter_vectors(64)
    got, has = language.bundles(["ab a"], letters)
    number = [0, 1, 2, 0, 1, 0]
    expected = np.zeros(64)
    for a, b, c in zip(number, number[1:], number[2:], strict=False):
        if b:
            expected += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    assert has[0] and (got[0] == expected).all()


def test_scores_base_equals_brute_force(spark, docs, texts):
    training = language.remainder("doc_id", 7) != 2
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i in range(len(texts))]
    tokens = [[*words_of(t), None] for t in texts]
    counts = Counter(w for t, on in zip(tokens, train, strict=True) if on for w in t)
    n, v = sum(counts.values()), len(counts)
    for r in mixing.score_texts(spark, docs, training).collect():
        own = tokens[r["doc_id"]]
        assert r["held_out"] == (not train[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert r["score"] < 0


def test_scores_of_all_next_symbols_are_a_distribution():
    r = np.random.default_rng(2)
    counts = r.integers(0, 9, int(mixing._STARTS[-1])).astype(np.int32)
    model = mixing.Model(counts)
    text = b"abc"
    total = 0.0
    for symbol in range(256):
        data = np.frombuffer(text + bytes([symbol]), dtype=np.uint8)
        total += 10 ** model.score(data, np.array([0, len(data)]))[0]
    before = 10 ** model.score(np.frombuffer(text, dtype=np.uint8), np.array([0, 3]))[0]
    assert math.isclose(total, before, rel_tol=1e-3)


def test_scores_beat_even_chances_and_untrained_is_even(spark, docs, none):
    assert mixing.score_texts(spark, none, F.lit(True)).count() == 0
    found = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.score_texts(spark, found, language.remainder("doc_id", 7) != 2).join(found.select("doc_id", F.octet_length("text").alias("b")), "doc_id").where("held_out and b > 500").collect()
    bits = -sum(r["score"] for r in rows) / math.log10(2) / sum(r["b"] for r in rows)
    assert bits < 4
    assert all(r["n_known"] == 0 and r["base_score"] == 0 for r in mixing.score_texts(spark, docs, F.lit(False)).collect())


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:y}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu, item</a></li></ul></nav><div class="cookie-notice">We use cookies, accept them now please.</div>
<div id="content"><article><h1>The head</h1><p>First paragraph of   the article, with commas, and words &amp; signs.<p><b>Second paragraph&nbsp;is
unclosed, too, and long enough to count.</b><ul><li>an item</li></ul><form><input name=q><label>Search here</label></form><p>Short.</p></article>
<div class="comments"><p>A reader says, at length, that this was nice, very nice indeed.</p></div></div>
<aside><p>Side text, which is long enough to be scored, were it kept.</p></aside><div class="ad">Buy, buy, buy more of this today!</div><footer>&copy; x</footer></body></html>"""


def test_pages():
    assert content.main_text(PAGE) == "The head\nFirst paragraph of the article, with commas, and words & signs.\nSecond paragraph is unclosed, too, and long enough to count.\nan item\nShort."
    assert content.main_text(None) == "" and content.main_text("") == ""
    assert content.main_text("plain text &lt;only") == "plain text <only"
    assert content.main_text("<p>cut off in the middle, of a page, which is long enoug<di") == "cut off in the middle, of a page, which is long enoug"
    assert content.main_text("<div>" * 3000 + "deep") == "deep"


def test_pages_table(spark, work):
    df = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (2, "v", "")], "page_id bigint, url string, html string")
    assert sorted((r["page_id"], r["n_chars"]) for r in content.extract(df).collect()) == [(1, len(content.main_text(PAGE))), (2, 0), (2, 0)]
    assert content.extract(df.limit(0)).count() == 0


def test_near_vectors_equal_brute_force(spark, work, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    r = np.random.default_rng(4)
    rows, k = [], 0
    for label in (1, 2):
        for _ in range(25):
            base = r.standard_normal(32)
            for _ in range(r.integers(1, 8)):
                rows.append((k, (base + 0.1 * r.standard_normal(32) * r.random()).astype(np.float32).tolist(), label))
                k += 1
    rows += [(k + i, rows[0][1], 1) for i in range(40)]
    k += 40
    rows += [(k, rows[0][1], None), (k + 1, None, 1), (k + 2, [0.0] * 32, 1), (k + 3, [float("nan")] * 32, 1), (k + 4, [], 1), (k + 5, [1.0, None], 1)]
    found = {x["vec_id"]: x for x in near_vectors.near_vectors(spark, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, label in rows if label and v and None not in v and np.isfinite(v).all() and any(v)}
    labels = {i: label for i, _, label in rows}
    links = [(a, b) for a in unit for b in unit if a < b and labels[a] == labels[b] and unit[a] @ unit[b] >= 0.98]
    component = components(links, [x[0] for x in rows])
    n = Counter(i for pair in links for i in pair)
    linked = sum(found[i]["n_links"] for i in found)
    assert linked <= 2 * len(links) and linked >= 0.99 * 2 * len(links)
    assert sum(found[i]["component_id"] != component[i] for i in found) <= 1
    assert all(found[i]["kept"] == (found[i]["component_id"] == i) for i in found)
    assert all(found[i]["n_links"] <= n[i] for i in found)


def test_licences_equal_unpruned_comparison(spark, docs, none, texts):
    matcher = license.Matcher()

    def plain(text):
        found = (None, 0.0)
        for unit in {text, *text.split("\n")}:
            own = license.bigrams(unit)
            for name, theirs in matcher.sets.items():
                dice = 2 * len(own & theirs) / (len(own) + len(theirs)) if own else 0
                if dice >= license.THRESHOLD and (dice > found[1] or dice == found[1] and name < found[0]):
                    found = name, dice
        return found

    lines = [*(t or "" for t in texts), *license.TEMPLATES.values(), "x\nreleased under  THE mit license", "Licensed under the Apache License", "under the License"]
    for line in lines:
        assert matcher.scan(line)[:2] == plain(line)
    assert license.scan_licenses(docs).where("license is not null").count() == 0
    assert license.scan_licenses(none).count() == 0


def test_word_spans():
    data, offsets = tk.text_buffers(pa.array(["a b", None, " c", "d"]))
    starts, ends, counts = tk.byte_words(data, offsets)
    assert [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)] == [b"a", b"b", b"c", b"d"]
    assert counts.tolist() == [2, 0, 1, 1]


def test_pipeline_equals_brute_force(spark, work):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    judged = {r["doc_id"]: r["kept"] for r in rules.apply_rules(spark.createDataFrame(list(docs.values()), DOCUMENTS)).select("doc_id", "kept").collect()}
    kept = [i for i in sorted(docs) if judged[i] and any(c.isalpha() for c in docs[i]["text"] or "")]
    component = brute_jaccard([docs[i]["text"] for i in kept])[1]
    expected = {kept[i] for i in component if component[i] == i}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == expected
    for r in rows:
        assert r["start"] + r["length"] <= r["doc_tokens"]
    total = Counter()
    for r in rows:
        total[r["doc_id"]] += r["length"]
    assert all(total[r["doc_id"]] == r["doc_tokens"] for r in rows)


CLASHING = ("score", "lang_pred", "row", "number", "n_words", "_text", "_words", "kept", "component_id", "label")


def test_stages_keep_rows_without_id_or_with_one_id_and_clashing_columns(spark, work, tmp_path):
    """Every stage but the last: NULL ids, one id for different texts, and columns named like working columns."""
    import random

    r = random.Random(4)
    words = "the of and to in is that it for was with house river stone garden letter morning water people small green".split()
    texts = [" ".join(r.choice(words) for _ in range(90)) for _ in range(12)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[0] + " more"), (7, texts[2]), (7, texts[3]), (8, texts[2]), (9, texts[4]), (10, None), (11, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCUMENTS).withColumns({c: F.lit(f"own {c}") for c in CLASHING})
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    after = {}
    for name in ("language_id", "quality_rules", "near_duplicates"):
        docs.transform(lambda d: stages[name](spark, d, str(tmp_path))).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == df.columns and all(x[c] == f"own {c}" for x in docs.collect() for c in CLASHING)
        after[name] = sorted(((x["doc_id"], x["text"]) for x in docs.collect()), key=str)
    assert after["language_id"] == sorted(((i, t) for i, t in rows if t), key=str) == after["quality_rules"]
    kept = after["near_duplicates"]
    # the texts 0 and 0 + more are near copies without ids: one stays; text 2 is in 7 and 8: 7 stays
    assert len(kept) == 5 and {t for _, t in kept} >= {texts[1], texts[2], texts[3], texts[4]} and (8, texts[2]) not in kept
    stages["packing"](spark, docs, str(tmp_path)).collect()
    empty = spark.createDataFrame([], df.schema)
    for name in ("language_id", "quality_rules", "near_duplicates", "packing"):
        assert stages[name](spark, empty, str(tmp_path)).count() == 0


def test_rules_query_with_clashing_columns(spark, work, tmp_path):
    from tidemark.llm import queries

    df = spark.createDataFrame(rows_of(["one two three", None]), DOCUMENTS).withColumns({c: F.lit(1) for c in ("n_words", "_text", "kept")})
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert [x["n_words"] for x in queries.op4_quality_rules(spark, str(tmp_path)).orderBy("doc_id").collect()] == [3, 0]


TWO = "<p>One paragraph, long enough to score, with commas.</p><p>Another paragraph, long enough too, with a comma.</p>"
TEXT = "One paragraph, long enough to score, with commas.\nAnother paragraph, long enough too, with a comma."
MENU = "<ul><li><a href=x>Home and more</a></li><li><a href=y>About all of us</a></li></ul>"


@pytest.mark.parametrize("page,text", [
    (f"<body><article><h1>T</h1><div>{TWO}</div></article></body>", f"T\n{TEXT}"),
    (f"<body><header>Site</header><article><header><h1>Head</h1></header>{TWO}</article><footer>end</footer></body>", f"Head\n{TEXT}"),
    (f"<body><div class='content with-sidebar'>{TWO}</div><div class=sidebar>{TWO}</div></body>", TEXT),
    (f"<body><div class='post share-enabled'><h2>T</h2>{TWO}</div><div>{MENU}</div></body>", f"T\n{TEXT}"),
    (f"<body><article>{TWO}{TWO}{TWO}</article><article><h2>B</h2><p>A short second article, of one sentence.</p></article></body>", f"{TEXT}\n{TEXT}\n{TEXT}\nB\nA short second article, of one sentence."),
    (f"<body><div id=page-with-comments><main><section>{TWO}</section><section><h2>More</h2><ul><li>an item</li></ul></section></main></div></body>", f"{TEXT}\nMore\nan item"),
    (f"<body><article>{TWO}<div class=comments>{TWO}{TWO}{TWO}{TWO}</div><aside>{TWO}</aside></article></body>", TEXT),
    (f"<body><div>{MENU}</div><div><div>{TWO}</div><div><h2>Second</h2><table><tr><td>cell</td></tr></table></div></div></body>", f"{TEXT}\nSecond\ncell"),
    ("<body>" + "<span>" * 3000 + "deep inline text, long enough to count</body>", "deep inline text, long enough to count"),
])
def test_articles_keep_their_blocks(page, text):
    assert content.main_text(page) == text


def test_pages_equal_a_plain_reader(spark, work):
    """The pages of the test tables keep their text in one article element: a plain reader of that is the reference."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.inside, self.out = 0, [""]

        def handle_starttag(self, tag, attrs):
            self.inside += tag == "article"
            if tag in content.BLOCKS:
                self.out.append("")
            elif tag == "br":
                self.out[-1] += " "

        def handle_endtag(self, tag):
            self.inside -= tag == "article"
            if tag in content.BLOCKS:
                self.out.append("")

        def handle_data(self, data):
            if self.inside > 0:
                self.out[-1] += data

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in content.extract(pages).collect():
        reader = Reader()
        reader.feed(html[r["page_id"]] or "")
        reader.close()
        assert r["text"] == "\n".join(t for t in (" ".join(b.split()) for b in reader.out) if t), r["page_id"]


def test_empty_tables_of_language_and_vectors(spark, work, none):
    assert language.identify(none, language.train(none)).count() == 0
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert near_vectors.near_vectors(spark, empty).count() == 0
