from __future__ import annotations

import os
import random

import pytest
from corpus_rows import DOCUMENTS, rows_of

@pytest.fixture(scope="session")
def work(spark, tmp_path_factory):
    """The shared folder of these tests."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return spark.conf.get("spark.checkpoint.dir")


@pytest.fixture(scope="session")
def texts():
    """Words, white space of all kinds, marks, other scripts, empty and NULL texts, copies and a long text."""
    r = random.Random(5)
    alphabet = list("abst'lremvd  \n\t\r!?.,0123<|>é²ʹ́   \x1c\x1f\x85漢字🙂ΣσİÀÉ​ß")
    out = ["", None, " ", "a", "<|endoftext|>x", "'s's 're 'r", "it's we've I'll", "a\n\n b", "ΑΣ ΣΑΣ", "a", "a"]
    out += ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(150)]
    out.append(" ".join("".join(r.choice("abcdeilnorst") for _ in range(r.randint(1, 12))) for _ in range(6000)))
    out.append("x" * 3000)
    return out


@pytest.fixture(scope="session")
def docs(spark, work, texts):
    return spark.createDataFrame(rows_of(texts), DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def none(spark, work):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def folder(spark, work, docs):
    """A data folder that holds the documents above, with columns that clash with results."""
    path = os.path.join(work.replace("file://", ""), "folder")
    docs.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return path
