"""The enrichment chain by rows against the same chain by columns, and what it costs the plan."""

import random

from jobloom.plans import enrich as E

_WORDS = {
    "title": ["Private Equity", "Associate", "private equity associate", "Child Protection Officer", "driver", "Accountant", "office manager", "Investment Officer", "venture partner", "due diligence", "MEL adviser", "software engineer", "Équity analyst", "payroll", "ngo", "&amp; Co", "hr officer", "x_y", "intern", "project finance", "deal execution", "fund accountant", "humanitarian officer"],
    "org_name": ["Harbour Growth Fund", "HGF", "River Development Bank", "Open Relief", "careers", "Ltd", "PLC", "Sky Telecom", "World Children Agency", "Lake University", "Ministry of Water", "Nobody", "Plain Foods", "limited", "jobs"],
    "location_raw": ["Nairobi", "Kenya", "KE", "NGA", "UZ", "US", "Dakar", "Turkana", "Borno State", "Lagos", "Tashkent", "Remote", "Africa", "West Africa", "United Kingdom", "England", "(GB)", "|DE|", "Le Caire", "Afrique du Sud", "hybrid", "EMEA", "ke", ",", "Cape Town/ZA", "القاهرة", "TZA ", "EG\n"],
    "summary": ["deal execution", "logframe", "international applicants are welcome", "nationals only", "kenyan", "british", "must have valid work permit", "open to all African countries", "seed stage", "displaced", "safe spaces", "local hire", "staff only", "worldwide", "remote", "due diligence", "solar", "Uzbekistan", "citizens only", "us residents only", "citizens of any african country", "farm"],
    "raw_terms": ["Analytics", "MEL", "1000 Eng", "deals", "misc", "other", "legacy", "Buyouts", " data  analysis ", "Accounting", "", "no_such", "Private Equity", "Backend Engineering", "Monitoring &amp; Evaluation"],
}
_SOME = {
    "source_key": ["boards", "relief", "Boards ", "*", "x", None], "source_label": ["Hosted Boards", "job  market", "Públic Gazette", "Employer boards", "", None], "mode_hint": ["Remote", "on-site", "híbrido", "Hybrid", None, None],
    "source_url": ["https://a.boards.example.com/1", "http://example.net", "https://k.ats.example.io/", "not a url", "https://ats.example.io", "https://x.test/", None], "location_country": ["Kenya", " ke ", "NGA", "Uzbekistan", "Nowhere", "", "Deutschland", None, None, None, None, None],
    "industry": ["technology", "public_sector", "retail", None, None, None], "eligibility_notes": ["staff only", "visa sponsorship provided", None, None, None],
}
_SCHEMA = "id string, title string, org_name string, location_raw string, summary string, raw_terms array<string>, " + ", ".join(f"{c} string" for c in _SOME) + ", apply_url string, apply_is_official boolean, sector string"


def _postings(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    text = lambda c, sep=" ": None if rng.random() < 0.08 else sep.join(rng.choices(_WORDS[c], k=rng.randrange(5)))
    return [
        (str(i // 2), text("title"), text("org_name"), text("location_raw", rng.choice([" ", ", "])), text("summary"), None if i % 13 == 0 else [None if x == "no_such" and i % 2 else x for x in rng.choices(_WORDS["raw_terms"], k=rng.randrange(6))],
         *(rng.choice(v) for v in _SOME.values()), rng.choice(["https://a.test/1", "", None]), rng.choice([True, False, None]), f"s{i}")
        for i in range(n)
    ]


def test_by_rows_and_by_columns_are_the_same(spark, monkeypatch):
    postings = spark.createDataFrame(_postings(1_500, 7), _SCHEMA).coalesce(2)
    by_row = E.enrich(postings)
    monkeypatch.setattr(E, "_whole", lambda *_: None)
    by_columns = E.enrich(postings)
    assert sorted(by_row.columns) == sorted(by_columns.columns)
    got, want = ({r["sector"]: r.asDict(True) for r in df.collect()} for df in (by_row, by_columns))
    assert len(want) == 1_500
    for key, row in want.items():
        for c, value in row.items():
            assert got[key][c] == value, (c, row)
    for profile, field, least in (("investment_profile", "track", 4), ("ngo_profile", "track", 3), ("africa_relevance", "status", 6), ("african_applicant_access", "status", 8), ("loc", "confidence", 5)):
        assert len({str(r[profile][field]) for r in want.values()}) >= least, profile
    assert by_row.select(*by_columns.columns).schema.simpleString() == by_columns.schema.simpleString()


def test_the_plan_by_rows_has_few_layers(spark):
    plan = E.enrich(spark.createDataFrame(_postings(3, 1), _SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and plan.count("Project") < 20


def test_normalisers_by_tables_of_characters():
    """Texts of all scripts, against the definitions character by character."""
    import html
    import re
    import unicodedata

    from jobloom.functions import normalise as N

    bare = lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    want = {
        N.norm_ascii_fold: lambda x: re.sub(r"[^a-z0-9]+", " ", bare(x).lower()).strip(" "),
        N.norm_ngo: lambda x: re.sub(r"[^a-z0-9]+", " ", bare(x).casefold()).strip(" "),
        N.norm_word: lambda x: re.sub(r"[^\w]+", " ", bare(unicodedata.normalize("NFKD", html.unescape(x)).casefold())).strip(),
        N.norm_unicode: lambda x: " ".join("".join(c if unicodedata.category(c)[0] in "LN" else " " for c in unicodedata.normalize("NFKC", x).casefold()).split()),
    }
    key = lambda x: re.sub(r"[^\S\x1c-\x1f]+", " ", html.unescape(x)).strip(" ").casefold()
    rng = random.Random(3)
    points = [p for p in range(0x3100) if not 0xD800 <= p < 0xE000] + [0x1F600, 0x1D7D8, 0xFB03, 0xFF21]
    texts = ["".join(map(chr, points[i : i + 40])) for i in range(0, len(points), 40)] + ["".join(chr(rng.choice(points[: 128 if i % 2 else None])) for _ in range(30)) for i in range(2_000)]
    texts += [f"a{chr(p)}B {chr(p)}" for p in points]
    for text in texts:
        for normaliser, plain in want.items():
            assert N.PLAIN[normaliser](text) == plain(text), (normaliser.__name__, text)
        assert N._taxonomy_key(text) == key(text), text


def test_keys_for_duplicates_are_as_the_pattern_says(spark):
    from pyspark.sql import functions as F

    from jobloom.functions import normalise as N

    rng = random.Random(5)
    parts = ["Ltd", "ltd.", "co", "CO-op", "a_ltd", "ltd_", "_", "inc", "Company", "company's", "companý", "Äcme", "é", "̈ltd", "ltď", "co‍", "Kltd", "ß", "plc", "الشركة", "limited", "x", "9", "-", "\t", "\n", "ⓐco", "co'", "llc,llc", ""]
    texts = [(i, "".join(x + rng.choice(["", " ", " ", "."]) for x in rng.choices(parts[: 12 if i % 3 else None], k=rng.randrange(7)))) for i in range(3_000)] + [(-1, None)]
    folded = spark.createDataFrame([(i, t, (t or "").casefold()) for i, t in texts], "i int, t string, low string").coalesce(2)
    plain = F.trim(F.regexp_replace(F.regexp_replace("low", rf"(?U)\b({'|'.join(N.LEGAL_SUFFIXES)})\b", " "), "[^a-z0-9]+", " "))
    got = folded.select("i", "t", N.norm_dedup("t").alias("key"), plain.alias("want")).collect()
    assert len(got) == 3_001
    for r in got:
        assert r["key"] == r["want"], r
