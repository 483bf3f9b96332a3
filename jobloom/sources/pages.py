"""Official web pages, government tables and circulars to postings."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from jobloom.functions import extract as X
from jobloom.functions.normalise import html_to_text
from jobloom.operators.dedup import first_by_id
from jobloom.operators.lexicon import once


def _strings(*names: str) -> ArrayType:
    return ArrayType(StructType([StructField(n, StringType()) for n in names]))


# ---- H6, P10, P11. Titles of pages that aren't vacancies.
GENERIC_TITLES = [
    r"^javascript is disabled$", r"^enable javascript", r"^access denied$", r"^careers?$", r"^jobs?$", r"^vacanc(?:y|ies)$", r"^current vacancies$", r"^career opportunities$", r"^job opportunities$",
    r"^work(?:ing)? with us$", r"^join us$", r"^recruitment$", r"^opportunities$", r"^equal employment opportunity", r"^military veterans$", r"^privacy policy$", r"^terms (?:of use|and conditions)$",
    r"^about us$", r"^our people$", r"^talent community$", r"^register your interest$",
]


def clean_text(value: Column | str) -> Column:
    """H6: text of markup or plain text, white space collapsed, tags apart; null if nothing is left."""
    spaced = F.regexp_replace(F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit("")), "(<[A-Za-z/!][^>]*>)", " $1 ")
    return html_to_text(spaced, 1 << 30)


def _plain(title: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[^a-z0-9]+", " "))


def _valid(text: Column, organisation: Column | str | None = None) -> Column:
    """P10 of a title that is clean already."""
    plain = _plain(text)
    ok = F.length(text).between(4, 220) & ~plain.rlike("|".join(GENERIC_TITLES))
    if organisation is not None:
        name = _plain(F.col(organisation) if isinstance(organisation, str) else organisation)
        ok = ok & ((name == "") | (plain != name))
    return F.coalesce(ok, F.lit(False))


def _choose(a: Column, b: Column, organisation: Column | str | None = None) -> Column:
    """P11 of titles that are clean already."""
    ok_a, ok_b = _valid(a, organisation), _valid(b, organisation)
    richer = _plain(b).contains(_plain(a)) & (F.length(b) <= F.length(a) + 90)
    return F.when(ok_a & ok_b, F.when(richer, b).otherwise(a)).when(ok_a, a).when(ok_b, b)


def valid_title(title: Column | str, organisation: Column | str | None = None) -> Column:
    """P10: 4 to 220 characters, no page's generic title, not the organisation's name."""
    return _valid(clean_text(title), organisation)


def choose_title(listing: Column | str, page: Column | str, organisation: Column | str | None = None) -> Column:
    """The listing's title, unless only the page's is valid, or the page's extends it by up to 90 characters."""
    return _choose(clean_text(listing), clean_text(page), organisation)


# ---- H1, S20: JSON-LD.
_LD_KEYS = ("@graph", "itemListElement", "mainEntity", "hasPart")


def _job_objects(value: object) -> Iterator[dict]:
    stack = [value]
    while stack:
        now = stack.pop()
        if isinstance(now, list):
            stack += reversed(now)
        elif isinstance(now, dict):
            kinds = now.get("@type")
            if any(str(k).casefold() == "jobposting" for k in (kinds if isinstance(kinds, list) else [kinds]) if k):
                yield now
            stack += [now[k] for k in reversed(_LD_KEYS) if k in now]


def _job_texts(scripts: list[str]) -> list[str]:
    found = []
    for text in scripts:
        try:
            found += [json.dumps(x, ensure_ascii=False) for x in _job_objects(json.loads(text))]
        except ValueError:
            continue
    return found


@F.pandas_udf(ArrayType(StringType()))
def _ld_jobs(scripts: pd.Series) -> pd.Series:
    return scripts.map(lambda x: _job_texts(list(x)) if x is not None and len(x) else [])


def json_ld_jobs(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """H1: one row for each JobPosting object of a page's JSON-LD, at any depth of graph, list, main entity
    and part: the page's columns, job_pos and job (JSON text). The script bodies are cut out by the JVM;
    only pages that have any go through Python."""
    scripts = F.regexp_extract_all(F.col(html_col), F.lit(r"(?is)<script[^>]*type\s*=\s*[\"']?application/ld\+json[^>]*>(.*?)</script>"), 1)
    rows = pages.withColumn("scripts", scripts).where(F.size("scripts") > 0)
    return rows.select(*pages.columns, F.posexplode(_ld_jobs("scripts")).alias("job_pos", "job"))


def _job_field(path: str) -> Column:
    return F.nullif(F.trim(F.try_variant_get(F.try_parse_json("job"), path, "string")), F.lit(""))


def _job_location() -> Column:
    v = F.try_parse_json("job")
    one = F.coalesce(F.try_variant_get(v, "$.jobLocation", "variant"), F.try_variant_get(v, "$.applicantLocationRequirements", "variant"))
    many = F.coalesce(F.try_variant_get(one, "$", "array<variant>"), F.array(one))

    def parts(x: Column) -> Column:
        address = F.coalesce(F.try_variant_get(x, "$.address", "variant"), x)
        keys = [F.coalesce(F.try_variant_get(address, f"$.{k}.name", "string"), F.try_variant_get(address, f"$.{k}", "string")) for k in ("addressLocality", "addressRegion", "addressCountry", "name")]
        plain = F.try_variant_get(x, "$", "string")
        return F.when(F.substring(plain, 1, 1) == "{", F.array(*keys)).otherwise(F.array(plain))

    values = F.array_distinct(F.filter(F.array_compact(F.flatten(F.transform(F.array_compact(many), parts))), lambda s: F.trim(s) != ""))
    return F.coalesce(F.nullif(F.array_join(values, ", "), F.lit("")), F.when(F.lower(_job_field("$.jobLocationType")) == "telecommute", F.lit("Remote - Global")))


def from_job_objects(jobs: DataFrame, prefix: str = "official", org_col: str = "organisation_id") -> DataFrame:
    """JobPosting objects to postings (id, title, location_raw, posted_at, deadline, summary, apply_url, ...)."""
    text = F.coalesce(_job_field("$.description"), F.lit(""))
    url = F.coalesce(_job_field("$.url"), F.col("url"))
    years = X.years_experience(text)
    return jobs.select(
        X.stable_id(prefix, url).alias("hash_id"), F.concat(F.lit(f"{prefix}-"), org_col, F.lit("-"), F.substring(F.sha2(url, 256), 1, 16)).alias("id"), clean_text(_job_field("$.title")).alias("title"), _job_location().alias("location_raw"),
        X.timestamp(_job_field("$.datePosted")).alias("posted_at"), X.timestamp(_job_field("$.validThrough"), end_of_day=True).alias("deadline"), html_to_text(text).alias("summary"), url.alias("apply_url"),
        X.contract_type(_job_field("$.title"), F.concat_ws(" ", _job_field("$.employmentType"), text)).alias("contract_type"), years["years_min"].alias("years_experience_min"), years["years_max"].alias("years_experience_max"), F.col(org_col), F.lit("json_ld").alias("found_by"), F.col("job_pos").alias("pos"),
    ).drop("hash_id")


# ---- H2: candidate links.
class _Anchors(HTMLParser):
    """Links with their text, and the text of the element around them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str]]] = [("", [])]
        self.links: list[tuple[str, list[str], list[str]]] = []
        self.within: list[tuple[str, list[str], list[str]]] = []
        self.mute = 0

    VOID = {"br", "img", "input", "hr", "meta", "link", "area", "base", "col", "source", "wbr"}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.mute += 1
        if tag == "a" and (href := dict(attrs).get("href")):
            self.within.append((href, [], self.open[-1][1]))
        if tag not in self.VOID:
            self.open.append((tag, []))

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.mute = max(0, self.mute - 1)
        if tag == "a" and self.within:
            self.links.append(self.within.pop())
        if any(t == tag for t, _ in self.open[1:]):
            while len(self.open) > 1:
                name, text = self.open.pop()
                self.open[-1][1].extend(text)
                if name == tag:
                    break

    def handle_data(self, data: str) -> None:
        if not self.mute:
            self.open[-1][1].append(data)
            for _, text, _ in self.within:
                text.append(data)


def _squeeze(parts: list[str]) -> str:
    return " ".join(" ".join(parts).split())


def page_links(markup: str | None, base: str | None) -> list[dict]:
    reader = _Anchors()
    reader.feed(markup or "")
    reader.close()
    out = []
    for href, text, around in [*reader.links, *reader.within]:
        try:
            url = urljoin(base or "", href.strip())
            good = urlparse(url).scheme in ("http", "https") and urlparse(url).netloc
        except ValueError:
            continue
        if good:
            out.append({"link": url.split("#")[0], "text": _squeeze(text), "context": _squeeze(around)})
    return out


@F.pandas_udf(_strings("link", "text", "context"))
def _links(markup: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([page_links(m, b) for m, b in zip(markup, base, strict=True)])


def candidate_links(pages: DataFrame, include: str | None = None, exclude: str | None = None, titles: bool = True, id_col: str = "page_id") -> DataFrame:
    """H2: (page, pos, link, text, context): absolute links without fragment, by patterns, with a title's
    text, the first of each link."""
    rows = pages.select(id_col, F.posexplode(_links("html", "url")).alias("pos", "a")).select(id_col, "pos", "a.*")
    if include:
        rows = rows.where(F.col("link").rlike(f"(?i){include}") | F.col("text").rlike(f"(?i){include}"))
    if exclude:
        rows = rows.where(~F.col("link").rlike(f"(?i){exclude}"))
    if titles:
        rows = rows.where(valid_title("text"))
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy(id_col, "link").orderBy("pos")))
    return first.where("nth = 1").drop("nth")


# ---- H3, H4, H5. Labels of a place, wording of a vacancy.
LOCATION_LABELS = r"(?:duty station|job location|work location|location|lieu d'affectation|lieu de travail|localiza[cç][aã]o|local de trabalho|mahali pa kazi|مكان العمل)"
STRONG_URL = r"/(?:job|jobs|vacanc(?:y|ies)|position|requisition|opening)s?[/_-](?:[a-z0-9-]*\d|[a-z0-9-]{8,})"
REQUISITION = r"\b(?:requisition|vacancy|advert|reference|job)\s*(?:id|no\.?|number|ref(?:erence)?)\s*[:#-]?\s*[a-z0-9/-]{3,}\b"
DATES = r"\b(?:closing date|application deadline|valid through|posted on|date posted)\b"
SECTIONS = [r"\bresponsibilit(?:y|ies)\b", r"\brequirements?\b", r"\bqualifications?\b", r"\bduties\b", r"\bhow to apply\b", r"\bjob description\b"]


def location_candidates(markup: Column | str, context: Column | str) -> Column:
    """H3: candidate texts of a place in order: attributes, label and value in a list or a table, a
    label's line, then the same of the context around the link."""
    h = F.coalesce(F.col(markup) if isinstance(markup, str) else markup, F.lit(""))
    c = F.coalesce(F.col(context) if isinstance(context, str) else context, F.lit(""))
    pull = lambda text, pattern: F.regexp_extract_all(text, F.lit(f"(?isU){pattern}"), 1)
    found = F.concat(
        pull(h, r"itemprop=[\"']jobLocation[\"'][^>]*>([^<]{2,120})<"),
        pull(h, r"data-(?:job-)?location=[\"']([^\"']{2,120})[\"']"),
        pull(h, rf"<(?:dt|th)[^>]*>\s*{LOCATION_LABELS}\s*:?\s*</(?:dt|th)>\s*<(?:dd|td)[^>]*>(.{{2,120}}?)</(?:dd|td)>"),
        pull(F.regexp_replace(h, "<[A-Za-z/!][^>]*>", "  "), rf"{LOCATION_LABELS}\s*:\s*([^|;.:\n]{{2,80}}?)(?=\s{{2}}|[|;.:]|$)"),
        pull(c, rf"{LOCATION_LABELS}\s*:\s*([^|;.\n]{{2,80}})"),
    )
    bare = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[A-Za-z/!][^>]*>", " "), r"(?U)\s+", " "))  # noqa: E731  entities are left to clean_text
    return F.filter(F.transform(found, bare), lambda x: x != "")


def vacancy_evidence(text: Column | str, url: Column | str, title: Column | str, has_json_ld: Column | None = None) -> Column:
    """H4: is this a vacancy's page, and not a page about vacancies? text and title are clean already."""
    text, title = (F.col(c) if isinstance(c, str) else c for c in (text, title))
    u = F.lower(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")))
    specific = _valid(title) & (F.size(F.split(title, " ")) >= 2)
    sections = sum((X.has(text, p).cast("int") for p in SECTIONS[1:]), X.has(text, SECTIONS[0]).cast("int"))
    found = (u.rlike(STRONG_URL) & specific) | X.has(text, REQUISITION) | (specific & X.has(text, DATES) & (sections >= 1)) | (specific & (sections >= 2))
    return F.coalesce(found | (has_json_ld if has_json_ld is not None else F.lit(False)), F.lit(False))


def page_title(markup: Column | str) -> Column:
    """The first heading, else the page's title."""
    h = F.coalesce(F.col(markup) if isinstance(markup, str) else markup, F.lit(""))
    pull = lambda tag: F.nullif(F.regexp_extract(h, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1), F.lit(""))
    return clean_text(F.coalesce(pull("h1"), pull("title")))


def from_pages(pages: DataFrame, as_of: Column, prefix: str = "official") -> DataFrame:
    """Postings of official pages: JSON-LD if there is any, else evidence on the page; expired ones
    drop (P12), repeated ids keep the first. pages: (page_id, url, html, organisation_id, listing_title, context)."""
    jobs = from_job_objects(json_ld_jobs(pages), prefix)
    bare = pages.join(json_ld_jobs(pages).select("page_id").distinct(), "page_id", "left_anti")
    # Each clean text is a column of its own, so that it is computed once.
    bare = once(bare, {"page_text": clean_text("html"), "listed": clean_text("listing_title"), "headed": page_title("html")})
    bare = once(bare, {"chosen": _choose(F.col("listed"), F.col("headed"))})
    bare = once(bare.where(vacancy_evidence("page_text", "url", "chosen")), {"years": X.years_experience(F.col("page_text")), "closes": X.deadline(F.col("page_text"), F.year(as_of))})
    title, text, years = F.col("chosen"), F.col("page_text"), F.col("years")
    times = F.regexp_extract("html", r"(?is)<time[^>]*datetime=[\"']([^\"']+)[\"']", 1)
    rows = bare.select(
        F.concat(F.lit(f"{prefix}-"), "organisation_id", F.lit("-"), F.substring(F.sha2("url", 256), 1, 16)).alias("id"), title.alias("title"), clean_text(F.try_element_at(location_candidates("html", "context"), F.lit(1))).alias("location_raw"),
        X.timestamp(F.nullif(times, F.lit(""))).alias("posted_at"), F.col("closes").alias("deadline"), html_to_text("html").alias("summary"), F.col("url").alias("apply_url"), X.contract_type(title, text).alias("contract_type"),
        years["years_min"].alias("years_experience_min"), years["years_max"].alias("years_experience_max"), "organisation_id", F.lit("page").alias("found_by"), F.lit(0).alias("pos"),
    )
    open_ones = jobs.unionByName(rows).where(valid_title("title")).where(F.col("deadline").isNull() | (F.col("deadline") >= as_of))
    return first_by_id(open_ones)


# ---- S21: government tables. Header texts and what they stand for.
HEADERS = {
    "advert number": "advert_reference", "advert no": "advert_reference", "position": "title", "job title": "title", "post": "title", "job scale": "grade", "grade": "grade", "ministry": "ministry", "department": "ministry",
    "number of vacancies": "positions", "vacancies": "positions", "years of experience required": "experience", "experience": "experience", "advert date": "posted", "posting date": "posted", "advert close date": "deadline", "closing date": "deadline",
}


class _Tables(HTMLParser):
    """Rows of cells (text) with the links of each row."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[tuple[list[str], list[str]]]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append(([], []))
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            self.cell = []
            self.tables[-1][-1][0].append("")
        elif tag == "a" and self.tables and self.tables[-1]:
            given = dict(attrs)
            self.tables[-1][-1][1].extend(given[k] for k in ("href", "data-href", "data-url") if given.get(k))

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th"):
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)
            self.tables[-1][-1][0][-1] = _squeeze(self.cell)


def _safe_url(base: str, value: str | None) -> str | None:
    if not value or value.strip().casefold().startswith(("javascript:", "data:", "mailto:", "tel:", "#")):
        return None
    url = urljoin(base, value.strip())
    parts = urlparse(url)
    return url if parts.scheme in ("http", "https") and parts.netloc else None


def _table_rows(markup: str | None, base: str, form: str | None) -> list[dict]:
    reader = _Tables()
    reader.feed(markup or "")
    out = []
    for rows in reader.tables:
        heads = [HEADERS.get(k, k.replace(" ", "_")) for k in (" ".join("".join(c if c.isascii() and c.isalnum() else " " for c in cell.casefold()).split()) for cell in (rows[0][0] if rows else []))]
        if "title" not in heads:
            continue
        for cells, links in rows[1:]:
            record = dict(zip(heads, cells, strict=False))
            if len(cells) >= 2 and record.get("title"):
                url = next((u for x in links if (u := _safe_url(base, x))), None) or _safe_url(base, form) or base
                out.append({k: record.get(k) or None for k in ("title", "advert_reference", "grade", "ministry", "positions", "experience", "posted", "deadline")} | {"apply_url": url})
    return out


_ROW = _strings("title", "advert_reference", "grade", "ministry", "positions", "experience", "posted", "deadline", "apply_url")


@F.pandas_udf(_ROW)
def _government_rows(markup: pd.Series, base: pd.Series, form: pd.Series) -> pd.Series:
    return pd.Series([_table_rows(m, b or "", f) for m, b, f in zip(markup, base, form, strict=True)])


def government_posting(rows: DataFrame) -> DataFrame:
    """Common columns of adverts to postings. rows: portal_id, title, advert_reference, grade, ministry, positions,
    experience, posted_at, deadline, apply_url, location_raw, summary, citizenship_required, eligible_nationalities."""
    text = F.concat_ws(" ", "summary", "experience")
    identity = F.coalesce(F.col("advert_reference"), F.col("apply_url"))
    fields = F.struct("advert_reference", F.col("grade").alias("public_service_grade"), F.col("grade").alias("salary_scale"), X.first_integer("positions").alias("number_of_positions"), "citizenship_required", "eligible_nationalities", F.lit(False).alias("internal_only"))
    out = rows.select(
        F.concat(F.lit("gov-"), "portal_id", F.lit("-"), F.substring(F.sha2(F.concat_ws("|", identity, "title", "grade"), 256), 1, 18)).alias("id"), "title", F.coalesce("ministry", "portal_name").alias("org_name"), "location_raw", "summary",
        F.coalesce(X.industry("title", F.lit("")), F.lit("public_sector")).alias("industry"), X.first_integer("experience").alias("years_experience_min"), X.seniority("title").alias("seniority"), X.contract_type("title", text).alias("contract_type"), "posted_at", "deadline", "apply_url",
        F.lit(True).alias("apply_is_official"), F.when(F.col("citizenship_required"), F.concat(F.lit("Citizenship required: "), F.array_join("eligible_nationalities", ", "))).alias("eligibility_notes"), fields.alias("government_fields"), "portal_id", "pos",
    )
    return first_by_id(out)


def from_government_tables(pages: DataFrame) -> DataFrame:
    """One posting for each row of a table that has a column of titles. pages: portal_id, portal_name, url, html, form_url, country_name, citizenship_required, eligible_nationalities."""
    rows = pages.select("*", F.posexplode(_government_rows("html", "url", "form_url")).alias("pos", "r"))
    summary = F.nullif(F.concat_ws(" | ", "r.ministry", F.when(F.col("r.experience").isNotNull(), F.concat(F.lit("Experience: "), "r.experience", F.lit(" years")))), F.lit(""))
    named = rows.select("portal_id", "portal_name", "pos", "r.title", "r.advert_reference", "r.grade", "r.ministry", "r.positions", "r.experience", "r.apply_url", F.col("country_name").alias("location_raw"), summary.alias("summary"), "citizenship_required", "eligible_nationalities", (X.day_month_year("r.posted") - F.expr("interval 86399 seconds")).alias("posted_at"), X.day_month_year("r.deadline").alias("deadline"))
    return government_posting(named)


# ---- S22, S23: circulars.
_SWAHILI_BLOCK = r"(?m)^\s*\d+(?:\.\d+)*\.?\s+(.+?)\s*[-–]\s*NAFASI\s+(\d+)"


def from_advert_text(circulars: DataFrame) -> DataFrame:
    """Numbered headings "... - Nafasi N" cut an advert into posts. circulars: portal_id, portal_name, url, text, country_name, eligible_nationalities."""
    blocks = circulars.select("*", F.posexplode(F.filter(F.split("text", r"(?im)(?=^\s*\d+(?:\.\d+)*\.?\s+.+?\s*[-–]\s*NAFASI\s+\d+)"), lambda b: b.rlike(f"(?i){_SWAHILI_BLOCK}"))).alias("pos", "block"))
    pick = lambda g: F.trim(F.regexp_extract("block", f"(?i){_SWAHILI_BLOCK}", g))
    closes = X.deadline("text", F.lit(2026))
    rows = blocks.select(
        "portal_id", "portal_name", "pos", pick(1).alias("title"), F.lit(None).cast("string").alias("advert_reference"), F.nullif(F.trim(F.regexp_extract("block", r"(?i)(TGS\s*[A-Z]|PGSS\s*\d+|ngazi ya mshahara\s*:?\s*([A-Z0-9 .]+))", 1)), F.lit("")).alias("grade"), F.lit(None).cast("string").alias("ministry"), pick(2).alias("positions"),
        F.nullif(F.regexp_extract("block", r"(?i)miaka\s*(\d+)", 1), F.lit("")).alias("experience"), F.lit(None).cast("timestamp").alias("posted_at"), closes.alias("deadline"), F.col("url").alias("apply_url"), F.col("country_name").alias("location_raw"), html_to_text("block").alias("summary"),
        X.has("text", "raia wa tanzania|lazima awe raia|citizens? of tanzania").alias("citizenship_required"), "eligible_nationalities",
    )
    return government_posting(rows)


def from_circular_text(circulars: DataFrame) -> DataFrame:
    """S23: "POST ref : title" cuts a circular into posts, with sections for salary, centre, requirements and closing date."""
    head = r"(?im)^\s*POST\s+([0-9A-Z/ .-]+?)\s*:\s*(.+)$"
    blocks = circulars.select("*", F.posexplode(F.filter(F.split("text", r"(?im)(?=^\s*POST\s+[0-9A-Z/ .-]+?\s*:)"), lambda b: b.rlike(head))).alias("pos", "block"))
    section = lambda name: F.nullif(F.trim(F.regexp_extract("block", rf"(?im)^\s*{name}\s*:\s*(.+)$", 1)), F.lit(""))
    rows = blocks.select(
        "portal_id", "portal_name", "pos", F.trim(F.regexp_extract("block", head, 2)).alias("title"), F.trim(F.regexp_extract("block", head, 1)).alias("advert_reference"), section("SALARY").alias("grade"), F.lit(None).cast("string").alias("ministry"), F.nullif(F.regexp_extract("block", r"(?i)\((?:X)?(\d+)\s*POSTS?", 1), F.lit("")).alias("positions"),
        F.nullif(F.regexp_extract("block", r"(?i)(\d+)\s*years", 1), F.lit("")).alias("experience"), F.lit(None).cast("timestamp").alias("posted_at"), F.coalesce(X.deadline("block", F.lit(2026)), X.deadline("text", F.lit(2026))).alias("deadline"), F.col("url").alias("apply_url"), F.coalesce(section("CENTRE"), "country_name").alias("location_raw"), html_to_text(F.coalesce(section("REQUIREMENTS"), F.col("block"))).alias("summary"),
        F.lit(True).alias("citizenship_required"), "eligible_nationalities",
    )
    return government_posting(rows)


def latest_circulars(documents: DataFrame, most: int) -> DataFrame:
    """Of each portal the documents of the circular with the highest (year, number), the first `most` distinct ones.
    documents: portal_id, year, number, url, pos."""
    newest = documents.withColumn("r", F.dense_rank().over(Window.partitionBy("portal_id").orderBy(F.desc("year"), F.desc("number")))).where("r = 1")
    once = newest.withColumn("nth", F.row_number().over(Window.partitionBy("portal_id", "url").orderBy("pos"))).where("nth = 1")
    return once.withColumn("k", F.row_number().over(Window.partitionBy("portal_id").orderBy("pos"))).where(F.col("k") <= most).drop("r", "nth", "k")


def from_rss(feeds: DataFrame) -> DataFrame:
    """S7, the other envelope: items of an RSS feed. feeds: (source_key, target_id, payload)."""
    items = feeds.select("source_key", "target_id", F.posexplode(F.regexp_extract_all("payload", F.lit(r"(?is)<item[^>]*>(.*?)</item>"), 1)).alias("pos", "item"))
    tag = lambda name: clean_text(F.regexp_replace(F.regexp_extract("item", rf"(?is)<{name}[^>]*>(.*?)</{name}>", 1), r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1"))
    return items.select("source_key", "target_id", "pos", tag("guid").alias("native_id"), tag("title").alias("title"), tag("link").alias("page_url"), X.timestamp(tag("pubDate")).alias("posted_at"), tag("description").alias("summary"))


