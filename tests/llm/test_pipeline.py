import base64
import hashlib
import random

import public_tokenizers
import tiktoken

import corpus_pipeline
from lahar.llm import mixing

from .test_lines import brute as brute_lines
from .test_neardup import brute as brute_near


def corpus():
    rng = random.Random(8)
    vocab = {"en": ["the", "thing", "other", "what", "when", "there"], "fr": ["le", "été", "quoi", "leur", "deux", "où"]}
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "fr"])
        words = [x + rng.choice(["", "a", "e", "o"]) for x in rng.choices(vocab[lang], k=rng.randint(20, 60))]
        text = " ".join(words) + f"\nAll rights reserved in {1990 + i % 20} by us.\n" + " ".join(rng.choices(vocab[lang], k=6))
        if i % 10 == 9:
            text = rows[-1][1].replace("the", "then", 1)
        rows.append((i, text, lang, f"src{i % 3}", len(text)))
    return [*rows, (500, "12 34 --", "en", "src0", 8), (501, None, "en", "src1", None), (502, "", "fr", None, 0)]


def test_matches_brute_force(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    kept = [(i, t) for i, t, *_ in rows if t and any(c.isalpha() for c in t)]
    after = {i: text for i, _, _, text in brute_lines(kept)}
    left = {i for i, _, _, stays in brute_near(sorted(after.items())) if stays}
    source = {i: s for i, _, _, s, _ in rows}
    mixed = mixing.mix(spark.createDataFrame([(i, after[i], source[i]) for i in sorted(left)], "doc_id long, text string, source string")).collect()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r.doc_id, enc.encode_ordinary(after[r.doc_id]), hashlib.sha256(after[r.doc_id].encode()).hexdigest()) for r in mixed for _ in r.shards)
    assert sorted((r.doc_id, list(r.ids), r.decoded_sha256) for r in got.collect()) == want


def test_stages_keep_columns(spark, tmp_path):
    docs = spark.createDataFrame(corpus()[:20], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_no_task_decodes_while_it_encodes(spark, tmp_path):
    docs = spark.createDataFrame(corpus()[:20], "doc_id long, text string, lang string, source string, n_chars long")
    plan = corpus_pipeline.byte_bpe(spark, docs, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "CoGroups" not in plan
