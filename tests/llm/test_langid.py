import random

from pyspark.sql import functions as F

from lahar.llm import langid

VOCAB = {"en": ["the", "and", "thing", "other", "what"], "de": ["der", "und", "nicht", "schön", "einer"], "fr": ["le", "été", "quoi", "leur", "deux"]}


def docs(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(VOCAB[x], k=30)), x) for i, x in enumerate(["en", "de", "fr"] * 30)]
    return spark.createDataFrame([*rows, (500, None, "en"), (501, "no language", None)], "doc_id long, text string, lang string")


def test_evidence_is_fused(spark):
    model = langid.text_model(docs(spark))
    assert model[0] == ["de", "en", "fr"]
    rows = [
        (1, "http://a.example.de/x", '<html lang="de"><p>der und nicht schön einer der und</p></html>'),
        (2, "http://b.example.com", '<html><script>the and thing</script><p>le été quoi leur deux deux</p></html>'),
        (3, "http://a.example.de/y", "<html><p>7 7</p></html>"),
        (4, None, None),
        (5, "not an address", '<HTML class=x LANG=fr-CA></HTML>'),
        (5, "not an address", '<HTML class=x LANG=fr-CA></HTML>'),
        (6, "https://u@www.b.example.com:80/z", "<html><p>the other thing and what the other</p></html>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    html = F.col("html")
    got = langid.identify(pages, model, ["page_id"], langid.page_text(html), langid.declared_in(html), langid.host_of(F.col("url"))).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 7
    assert [by[i].language for i in (1, 2, 5, 6)] == ["de", "fr", "fr", "en"]
    assert by[3].language == "de" and by[3].text_language is None  # by its host and suffix alone
    assert by[4].letters == 0 and by[4].posterior < 0.9
    assert all(0 < r.posterior <= 1 for r in got)
    assert langid.identify(pages.limit(0), model, ["page_id"], html, html, html).collect() == []


def test_without_training_texts(spark):
    model = langid.text_model(docs(spark).limit(0))
    got = langid.identify(docs(spark).limit(2), model, ["doc_id"], F.col("text"), F.col("lang"), F.lit("h")).collect()
    assert [r.language for r in got] == [None, None]


def test_held_out_accuracy(spark):
    rng = random.Random(9)
    model = langid.text_model(docs(spark))
    rows = [(i, " ".join(rng.choices(VOCAB[x], k=8)), x) for i, x in enumerate(["en", "de", "fr"] * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, truth string")
    got = langid.identify(df, model, ["doc_id", "truth"], F.col("text"), F.lit(None).cast("string"), F.lit("h.example.com")).collect()
    assert sum(r.language == r.truth for r in got) / len(got) > 0.97


def test_posterior_against_plain_arithmetic(spark):
    """Every step worked by hand for small tables: likelihood, own vote left out, hierarchy, declared, suffix."""
    import math
    from collections import Counter

    model = langid.text_model(docs(spark))
    names, table = model
    rows = [
        (1, "der und nicht", None, "a.example.de"),
        (2, "the and thing what", "en", "a.example.de"),
        (3, "le quoi leur", "de", "b.example.de"),
        (4, "", "fr", "www.other.com"),
        (5, "the other what", None, None),
        (6, "des mots sch\u00f6n &eacute;t&eacute;", "xx", "c.example.uk"),
    ]
    df = spark.createDataFrame(rows, "k long, words string, told string, at string")
    got = {r.k: r for r in langid.identify(df, model, ["k"], F.col("words"), F.col("told"), F.col("at"), references=True).collect()}
    import html

    logs, votes = {}, {}
    for k, words, _, _ in rows:
        cells, sizes = langid.trigram_cells([html.unescape(words).encode()])
        n = int(sizes[0])
        logs[k] = [langid.TEMPER * max(n, 1) ** (langid.GROWTH - 1) * float(table[j].astype("float32")[cells].sum(dtype=float)) for j in range(3)]
        votes[k] = names[max(range(3), key=lambda j: (logs[k][j], -j))] if n else None
    part = {k: (h, ".".join(h.split(".")[-2:]) if h else "", h.split(".")[-1] if h else None) for k, _, _, h in rows}
    code = lambda e: langid.SUFFIX_LANGUAGE.get(e, e)
    trust = {}
    for what, of in (("declared", lambda r: r[2]), ("suffix", lambda r: code(part[r[0]][2]))):
        known = [r for r in rows if of(r) in names and votes[r[0]]]
        trust[what] = (sum(of(r) == votes[r[0]] for r in known) + langid.TRUST[what] * langid.TRUST_ROWS) / (len(known) + langid.TRUST_ROWS)
    for k, _, told, _ in rows:
        prior = None
        for level in (None, 2, 1, 0):
            inside = [x for x in votes if x != k and (level is None or part[x][level:] == part[k][level:])]
            c = Counter(votes[x] for x in inside if votes[x])
            total = sum(c.values())
            prior = [(c[x] + 1) / (total + 3) for x in names] if prior is None else [(c[x] + p * langid.LEAN) / (total + langid.LEAN) for x, p in zip(names, prior)]
        fused = [x + math.log(p) for x, p in zip(logs[k], prior)]
        for what, value in (("declared", told), ("suffix", code(part[k][2]))):
            if value in names:
                share = min(max(trust[what], 0.5), 1 - 1e-6)
                fused = [f + math.log(share if x == value else (1 - share) / 2) for f, x in zip(fused, names)]
        top = max(fused)
        assert got[k].text_language == votes[k]
        assert got[k].language == names[fused.index(top)]
        assert abs(got[k].posterior - 1 / sum(math.exp(f - top) for f in fused)) < 1e-5
