"""Licence notices inside paragraphs, wrapped ones and bodies inside files, against all windows by brute force."""

import random

import pytest

from tidemark.llm import license

FILLER = "the parser reads each record once and keeps no state between files so a second run gives the same rows"


def plain(text, templates, threshold=license.THRESHOLD):
    """(name, dice) of the best window by comparing all of them, without any bound."""
    words, found = license.words_of(text), (None, 0.0)
    for name, texts in sorted(templates.items()):
        for t in texts:
            theirs, size = license.bigrams(t), len(license.words_of(t))
            for i in range(max(1, len(words) - size + 1)):
                own = license.bigrams(" ".join(words[i : i + size]))
                dice = 2 * len(own & theirs) / (len(own) + len(theirs)) if own else 0.0
                if dice >= threshold and dice > found[1]:
                    found = name, dice
    return found


def wrapped(text, width=7):
    words = text.split()
    return "\n".join(" * " + " ".join(words[i : i + width]) for i in range(0, len(words), width))


def found_in(spark, texts):
    rows = license.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).orderBy("doc_id").collect()
    return [(r["license"], r["dice"]) for r in rows]


def test_bodies_notices_and_headers_are_found_anywhere(spark):
    cases = [(name, f"{FILLER}.\n{wrapped(t)}\n{FILLER}") for name, texts in license.TEXTS.items() for t in texts]
    cases += [(name, f"{FILLER} {t} {FILLER}") for name, t in license.TEMPLATES.items()]
    cases += [("MIT", "Released under the MIT License. See the file for details and more")]
    found = found_in(spark, [text for _, text in cases])
    assert found == [(name, 1.0) for name, _ in cases]


def test_texts_without_a_notice_have_none(spark):
    texts = [None, "", "license", FILLER, "under the License", "a license plate and the terms and conditions of a contract " * 40]
    assert found_in(spark, texts) == [(None, 0.0)] * len(texts)


@pytest.mark.parametrize("seed", range(4))
def test_windows_equal_brute_force(seed):
    r = random.Random(seed)
    windows = license.Windows(license.TEXTS | {name: (*license.TEXTS.get(name, ()), t) for name, t in license.TEMPLATES.items()})
    templates = {name: [*license.TEXTS.get(name, ()), *([license.TEMPLATES[name]] if name in license.TEMPLATES else [])] for name in {*license.TEXTS, *license.TEMPLATES}}
    pool = [t for texts in templates.values() for t in texts]
    for _ in range(6):
        words = f"{FILLER} {r.choice(pool)} {FILLER}".split()
        for _ in range(r.randrange(0, 1 + len(words) // 5)):
            words[r.randrange(len(words))] = r.choice(FILLER.split())
        text = " ".join(words)
        assert (windows.best(text) or (None, 0.0)) == plain(text, templates)
