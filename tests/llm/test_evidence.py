"""Languages of the documents and of pages; evidence that decides where the text does not."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftlode.llm import evidence
from shiftlode.llm.evidence import identify, kept_rows, page_evidence, trigram_codes
from shiftlode.llm.queries import QUERIES


def test_documents(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet".replace("sf0.001", "sf0.1"))
    found = identify(documents).join(documents.select("doc_id", "lang"), "doc_id")
    total, right, kept = found.agg(F.count("*"), F.sum((F.col("language") == F.col("lang")).cast("int")), F.sum(F.col("kept").cast("int"))).first()
    assert right >= 0.995 * total and kept >= 0.995 * total


def test_declared_language_is_evidence_but_not_the_answer(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet".replace("sf0.001", "sf0.01")).filter("n_chars > 200")
    wrong = documents.withColumn("declared", F.when(F.col("doc_id") % 10 == 0, "fr").otherwise(F.col("lang")))
    found = identify(wrong, declared="declared").join(documents.select("doc_id", "lang"), "doc_id")
    total, right = found.agg(F.count("*"), F.sum((F.col("language") == F.col("lang")).cast("int"))).first()
    assert right >= 0.99 * total


def test_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet".replace("sf0.001", "sf0.01"))
    evidence = page_evidence(pages)
    assert evidence.filter("host IS NULL OR suffix IS NULL OR declared IS NULL").count() == 0
    found = identify(evidence, "page_id", "text", "declared", "host", "suffix")
    assert found.filter("language = declared").count() >= 0.98 * pages.count()


def test_host_prior_decides_short_texts(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet".replace("sf0.001", "sf0.01")).select("text", "lang")
    known = documents.withColumn("source", F.col("lang")).withColumn("doc_id", F.lit(1))
    short = spark.createDataFrame([(10, "xa", None, "de"), (11, "xa", None, "es")], "doc_id long, text string, lang string, source string")
    found = {r["doc_id"]: r["language"] for r in identify(known.unionByName(short)).filter("doc_id > 1").collect()}
    assert found == {10: "de", 11: "es"}


def test_rows(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = [(900, None, "en", "a"), (901, "", None, None), (902, "1234 !!", "en-US", None), (903, "漢字" * 3000, "zh", "b"), (None, None, None, None), (900, None, "en", "a")]
    rows = spark.createDataFrame(odd, documents.schema).unionByName(documents).withColumn("language", F.lit("x"))
    found = identify(rows)
    assert found.count() == rows.count()
    # The last row of `odd` and its repeat count too.
    assert found.filter("language = 'und'").count() == len(odd)
    assert found.filter("doc_id = 902").first()["declared"] == "en"
    kept = kept_rows(rows)
    assert kept.columns == rows.columns
    assert kept.filter("doc_id IS NULL OR doc_id >= 900").count() == 0 and kept.count() >= documents.count() - 2
    assert identify(rows.limit(0)).count() == 0 and kept_rows(rows.limit(0)).count() == 0


def test_slices_do_not_lose_letters():
    codes = [c for part in trigram_codes("ab cd") for c in part.tolist()]
    assert len(codes) == 5 and list(trigram_codes(None)) == [] and [len(x) for x in trigram_codes("12")] == []
    assert np.concatenate(list(trigram_codes("abc " * 400_000))).size > 1_590_000


def test_registered_query_reads_the_evidence_of_pages(spark, folder, tmp_path):
    documents = spark.read.parquet(f"{folder}/documents.parquet".replace("sf0.001", "sf0.01"))
    html = F.concat(F.lit('<html lang="'), "lang", F.lit('"><body><p>'), "text")
    address = F.concat(F.lit("http://h"), F.col("doc_id") % 9, F.lit("."), "lang", F.lit("/"), "doc_id")
    pages = documents.select(F.col("doc_id").alias("page_id"), address.alias("url"), html.alias("html"))
    short = [(-1, "https://new.de/a", "<p>xa"), (-2, "//new.es/", "<p>xa"), (-3, "http://new.org/", "<html lang='fr-CA'>xa"), (-4, None, None)]
    pages.unionByName(spark.createDataFrame(short, "page_id long, url string, html string")).write.parquet(f"{tmp_path}/pages.parquet")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op7_language_evidence"](spark, str(tmp_path)).cache()
    assert found.filter("page_id IS NULL").count() == documents.count()
    assert found.filter("doc_id IS NULL").count() == pages.count() + len(short)
    got = {r["page_id"]: (r["language"], r["declared"]) for r in found.filter("page_id < 0").collect()}
    assert got == {-1: ("de", "none"), -2: ("es", "none"), -3: ("fr", "fr"), -4: ("und", "none")}


def test_page_text_is_decoded_content(spark):
    html = "<html lang=de-AT><nav>menu</nav><div class='ad'>buy</div><article><p>f&uuml;r die M&auml;nner</p></article></html>"
    pages = spark.createDataFrame([(1, "http://x.Example.AT:80/a", html, "t"), (None, None, None, None)], "page_id long, url string, html string, text string")
    got = sorted(map(tuple, page_evidence(pages).collect()), key=str)
    assert got == [(1, "für die Männer", "de", "x.example.at", "at"), (None, "", None, None, None)]


def plain_fusion(rows, model):
    """The whole fusion over (key, text, declared, host, suffix), row by row in plain Python."""
    names, number = model.languages, len(model.languages)
    softmax = lambda x: [math.exp(a - max(x)) / sum(math.exp(b - max(x)) for b in x) for a in x]
    kinds = [*names[:-1], "other", "none"]
    read = []
    for key, text, declared, host, suffix in rows:
        tag = (declared or "").split("-")[0].split("_")[0].strip().lower()
        kind = "none" if not tag else tag if tag in names[:-1] else "other"
        data = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in (text or "").lower().encode())
        data = b" " + b" ".join(data.split()) + b" "
        logs, size = [0.0] * number, 0
        for a, b, c in zip(data, data[1:], data[2:]):
            mixed = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % 2**32
            row = model.logs[(mixed ^ (mixed >> 15)) % evidence.CODES].tolist()
            logs, size = [x + y for x, y in zip(logs, row)], size + 1
        pull = evidence.PULL / (size + evidence.PULL)
        read.append((key, kind, host, suffix, size, [x * pull for x in logs]))
    first = [(1 - evidence.SURPRISE) / (number - 1)] * (number - 1) + [evidence.SURPRISE]
    whole, told, suffixes, hosts = Counter(), defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, kind, host, suffix, size, logs in read:
        if size:
            for name, share in zip(names, softmax([x + math.log(y) for x, y in zip(logs, first)])):
                for counter in (whole, told[kind], suffixes[suffix], hosts[host, suffix]):
                    counter[name] += share
    total = sum(whole.values())
    general = {x: (whole[x] + 1) / (total + number) * (1 - evidence.SURPRISE) for x in names[:-1]} | {names[-1]: evidence.SURPRISE}
    smooth = lambda own, base, x: (own[x] + evidence.SMOOTH * base[x]) / (sum(own.values()) + evidence.SMOOTH)
    out = []
    for key, kind, host, suffix, size, logs in read:
        if not size:
            out.append((key, "und", 1.0, 0, False))
            continue
        said = [(told[kind][x] + 1) / (whole[x] + len(kinds)) for x in names[:-1]] + [(sum(told[kind].values()) + 1) / (total + len(kinds))]
        base = {x: smooth(suffixes[suffix], general, x) for x in names}
        prior = [smooth(hosts[host, suffix], base, x) for x in names]
        posterior = softmax([a + math.log(b) + math.log(c) for a, b, c in zip(logs, said, prior)])
        best = posterior.index(max(posterior))
        out.append((key, names[best], posterior[best], size, names[best] != "und" and posterior[best] >= evidence.MIN_POSTERIOR))
    return out


def test_fusion_equals_a_plain_one(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    suffixes, hosts = ["de", "com", None, "es"], ["a", "b", None, "c", "d"]
    rows = []
    for i, d in enumerate(documents):
        text = d["text"][: (12, 40, 400, 3000)[i % 4]]  # short texts, so that the other evidence matters
        declared = (d["lang"], None, "fr", f"{d['lang'].upper()}-xx", "zh")[i % 5]
        rows.append((d["doc_id"], text, declared, hosts[i % 5], suffixes[len(d["lang"] + text) % 4]))
    rows += [(9000, None, "en", "a", "de"), (9001, "", None, None, None), (9002, "12 !", "de", "a", "de"), (9003, "xqz", None, "new", "de"), (9004, "漢字漢字", "zh", "a", None)]
    df = spark.createDataFrame(rows, "key long, words string, declared string, host string, suffix string")
    model = evidence.fit(df, "words", "declared")
    fused = evidence._fused(df, model, "key", "words", "declared", "host", "suffix")
    got = {r["_key"]: r for r in fused.collect()}
    expected = plain_fusion(rows, model)
    assert len(got) == len(expected) >= 200
    assert len({language for _, language, *_ in expected}) == 5
    for key, language, posterior, size, kept in expected:
        row = got[key]
        assert (row["language"], row["n_trigrams"], row["kept"]) == (language, size, kept)
        assert row["posterior"] == pytest.approx(posterior, rel=1e-5)


def test_languages_without_the_declared_one(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet".replace("sf0.001", "sf0.01")).filter("n_chars > 40")
    model = evidence.fit(documents, "text", "lang")
    fused = evidence._fused(documents, model, "doc_id", "text", None, "source", None)
    met = fused.join(documents.select("doc_id", "lang"), fused["_key"] == documents["doc_id"])
    total, right = met.agg(F.count("*"), F.sum((F.col("language") == F.col("lang")).cast("int"))).first()
    assert right >= 0.99 * total
