import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from incident_engine.llm import (decontaminate, quality, quality_rules, sharding, toxicity,
                                 url_rules)


def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(inside))


def test_rules_count_whole_texts(documents, odd, empty):
    for docs in (documents.filter("doc_id % 5 = 0"), odd):
        want = sorted((base_counts(r.text) for r in docs.select("text").collect()))
        rows = quality_rules.judge(docs).collect()
        assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                      for r in rows) == want
        for r in rows:
            failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
            assert r.base_failed == failed and not (failed and r.kept) and 0 <= r.posterior <= 1
    assert quality_rules.judge(empty).count() == 0


def test_estimates_find_the_better_rule(spark):
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.6
    votes = {f"vote_{n}": np.where(rng.random(4000) < p, truth, ~truth).astype(int)
             for n, p in (("a", 0.95), ("b", 0.9), ("c", 0.6))}
    frame = spark.createDataFrame(pd.DataFrame(votes))
    share, yes = quality_rules.fit(frame, ["a", "b", "c"], 40)
    assert abs(share - 0.6) < 0.08
    assert yes["a"][0] > yes["c"][0] and yes["a"][1] < yes["c"][1]


def brute_rule(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = re.match(r"[^?#]*", rest[len(host):])[0]
    fit = [(len(r), v, r) for r, v in rules
           if ("." + host).endswith("." + r.split("/")[0]) and path.startswith(r[r.index("/"):])]
    best = max(fit, default=(0, "allow", None))
    return host, path, best[2], best[1]


def test_url_rules_match_brute_force(spark, medium, monkeypatch):
    monkeypatch.setattr(url_rules, "RANGE_ROWS", 40)
    urls = [r.url for r in spark.read.parquet(f"{medium}/pages.parquet").select("url").collect()]
    urls += [None, "", "no scheme", "http://", "file:///a/b", "x://COM", "x://com/", "x://a.com?q/",
             "x://example.com/en/x", "x://EXAMPLE.com/en", "x://a.b.net/es/1#x", "x://.net/fr/",
             "http://é.example.com/en/é", "x://xnet/es/", "x://a://b.com/en/", "x://n\net.com/\nz"]
    urls += ["https://hot.example.com/en/1"] * 300
    rules = url_rules.RULES + [("example.com/", "allow"), ("a.b.net/", "block"), ("b.net/es/", "allow")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    frame = spark.createDataFrame(rules + [(None, "allow"), ("/x", "block"), rules[0]],
                                  "rule string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
           for r in url_rules.filter_urls(pages.selectExpr("*", "1 as host", "2 as key"), frame).collect()}
    assert got == {i: brute_rule(u, rules) for i, u in enumerate(urls)}
    assert url_rules.filter_urls(pages.limit(0), frame).count() == 0
    assert url_rules.filter_urls(pages, frame.limit(0)).filter("rule is not null").count() == 0


def test_decontamination_in_blocks_and_odd_rows(spark, documents, odd, empty, medium):
    items = spark.read.parquet(f"{medium}/benchmark.parquet")
    extra = spark.createDataFrame([(900, "Again, AND again!"), (901, "..."), (902, None),
                                   (None, "same words here again"), (903, "")], "item_id long, text string")
    both = items.select("item_id", "text").union(extra)
    one = decontaminate.decontaminate(documents, both).toPandas().sort_values("doc_id")
    many = decontaminate.decontaminate(documents, both, block_bytes=2000).toPandas()
    pd.testing.assert_frame_equal(one.reset_index(drop=True),
                                  many.sort_values("doc_id").reset_index(drop=True))
    rows = decontaminate.decontaminate(odd, both).filter("contaminated").collect()
    assert {r.doc_id for r in rows} == {9, 10} and all(r.n_items == 1 for r in rows)
    assert rows[0].n_hit == rows[0].n_words == 180
    assert decontaminate.decontaminate(empty, both).count() == 0
    assert decontaminate.decontaminate(odd, both.limit(0)).filter("contaminated").count() == 0


@pytest.mark.parametrize(("module", "label", "held"), [(toxicity, "toxic", (3, 1)),
                                                       (quality, "quality", (4, 2))])
def test_classifiers_hold_on_held_out_rows(spark, documents, odd, empty, medium, module, label, held):
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    model = module.train(documents, labels, held)
    rows = toxicity.score(documents, model, held).join(labels, "doc_id").filter("held_out").toPandas()
    assert (rows["predicted"] == rows[label]).mean() > 0.9
    got = toxicity.score(odd, model, held).collect()
    assert len(got) == odd.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert toxicity.score(empty, model, held).count() == 0
    blank = module.train(empty, labels.limit(0), held)
    assert toxicity.score(odd, blank, held).count() == odd.count()


def test_isotonic_fit_is_monotone():
    rng = np.random.default_rng(2)
    raw = rng.normal(size=300)
    xs, ys = toxicity.isotonic(raw, (raw + rng.normal(size=300) > 0).astype(float))
    assert (np.diff(xs) >= 0).all() and (np.diff(ys) >= 0).all() and 0 <= ys.min() <= ys.max() <= 1


def test_shards_are_even_and_keep_groups(spark, documents, odd, empty):
    hot = spark.range(2000).selectExpr("id + 100000 as doc_id", "'the same' as text")
    for docs in (documents, documents.select("doc_id", "text").union(hot), odd):
        rows = sharding.shard_documents(docs).toPandas()
        sizes = rows.groupby("shard")["slot"].agg(["size", "min", "max", "nunique"])
        assert len(rows) == docs.count()
        assert sizes["size"].max() - (sizes["size"].min() if len(sizes) == 8 else 0) <= 1
        assert (sizes["max"] + 1 == sizes["size"]).all() and (sizes["nunique"] == sizes["size"]).all()
    rows = sharding.shard_documents(documents).toPandas()
    texts = documents.select("doc_id", "text").toPandas().merge(rows, on="doc_id")
    groups = texts.groupby("text")["shard"].agg(["size", "nunique"])
    assert (groups[groups["size"] > 1]["nunique"] == 1).mean() > 0.95
    assert sharding.shard_documents(empty).count() == 0


def test_shards_keep_small_groups_next_to_a_hot_one(spark):
    """A third of the rows is one text: it fills three shards, and all pairs of copies stay whole."""
    docs = spark.range(8000).selectExpr(
        "id as doc_id", "case when id < 2700 then 'hot' when id < 4300 then "
        "concat('pair', id div 2) else concat('own', id) end as text")
    rows = docs.join(sharding.shard_documents(docs).select("doc_id", "shard"), "doc_id").toPandas()
    groups = rows.groupby("text")["shard"].agg(["size", "nunique"])
    assert groups.loc["hot", "nunique"] == 3
    assert (groups[groups["size"] == 2]["nunique"] == 1).mean() > 0.99
    assert set(rows.groupby("shard").size()) == {1000}


def test_pipeline_stage_by_stage(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, seen = docs.columns, defaultdict(list)
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = [before, docs.count()]
        if name != "packing":
            assert docs.columns == columns and docs.count() <= before
    assert seen["suffix_dedup"][0] == seen["suffix_dedup"][1]
    assert seen["packing"][1] >= seen["packing"][0] > 0
    assert corpus_pipeline.run(spark, small).count() == seen["packing"][1]
