"""Matching and classification of postings as plain functions of a row's values, for the enrichment chain.

The same rules as in matching.py and classify.py, which state them as columns: there each rule is some ten layers of a
plan that copy the whole row, and arrays of found entries go through functions that Spark interprets. Here what is
found in a text is a few numbers in the worker, and only results leave it. A result depends on what was found, not on
the text, so it is made once for equal findings of a batch; where all differ, it is made for each row.

Each step is one Arrow function of columns that are there already, so a pass takes one Python worker and drops steps
that nobody reads. A step needs its registries whole: with one that is too large for that, the chain goes by columns.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from decimal import ROUND_HALF_UP, Decimal
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructType

from jobloom.functions.normalise import PLAIN, _taxonomy_key, norm_ascii_fold, norm_ngo, norm_unicode, norm_word
from jobloom.operators.lexicon import PhraseAutomaton

#: Results that a step keeps from one batch to the next, and normal forms of names and terms that steps share.
KEPT, SHARED = 1 << 12, 1 << 15

Entry = dict
_unicode, _word, _ngo = (PLAIN[n] for n in (norm_unicode, norm_word, norm_ngo))


@lru_cache(SHARED)
def _fold(name: str) -> str:
    return PLAIN[norm_ascii_fold](name)


@lru_cache(SHARED)
def _term(raw: str) -> str:
    return _taxonomy_key(raw)


def _ordered(value):
    """A value as Spark sorts it: null before all others, also inside of arrays."""
    if value is None:
        return (False,)
    return (True, [_ordered(v) for v in value] if isinstance(value, list) else value)


def _by(*values) -> tuple:
    return tuple(map(_ordered, values))


def _distinct(values: Iterable) -> list:
    return list(dict.fromkeys(values))


def _some(*values) -> list:
    return [v for v in values if v is not None]


def _under(text: str) -> str:
    return text.replace(" ", "_")


def _rounded(value: float) -> float:
    return float(Decimal(repr(value)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def _grouped(entries: list[Entry], key: str) -> dict[str, list[Entry]]:
    found: dict[str, list[Entry]] = {}
    for entry in entries:
        if entry[key] is not None:
            found.setdefault(entry[key], []).append(entry)
    return found


def _values(column: pa.Array) -> list:
    """The column's values; texts and arrays of texts by way of objects, which takes a fraction of to_pylist()'s time."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        return column.to_numpy(zero_copy_only=False).tolist()
    if pa.types.is_list(column.type) and pa.types.is_string(column.type.value_type):
        each, out, at = column.flatten().to_numpy(zero_copy_only=False).tolist(), [], 0
        for n in column.value_lengths().to_pylist():
            out.append(None if n is None else each[at : at + n])
            at += n or 0
        return out
    return column.to_pylist()


def step(kind: DataType, build: Callable[[], tuple[Callable, Callable]]):
    """An Arrow function of several columns. build() gives (asked, answer) once for each task: asked(*values of a row) is
    what the result depends on, and can be hashed; answer(asked) is the result."""
    made: list = []
    wanted = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def run(*columns: pa.Array) -> pa.Array:
        if not made:
            asked, answer = build()
            made.extend((asked, lru_cache(KEPT)(answer)))
        asked, answer = made
        places: dict = {}
        at = [places.setdefault(asked(*values), len(places)) for values in zip(*map(_values, columns), strict=True)]
        return pa.array([answer(x) for x in places], wanted).take(pa.array(at, pa.int32()))

    return run


class Phrases:
    """Which entries of a registry have their phrase in a text, as sorted numbers of entries."""

    def __init__(self, entries: list[Entry], key: str, plain: Callable[[str], str]) -> None:
        self.root, self.plain = PhraseAutomaton([e[key] for e in entries]).root, plain

    def among(self, tokens: list[str]) -> tuple[int, ...]:
        root, found = self.root, set()
        for start in [i for i, t in enumerate(tokens) if t in root]:
            node, at = root[tokens[start]], start
            while node is not None:
                found.update(node.get("", ()))
                at += 1
                node = node.get(tokens[at]) if at < len(tokens) else None
        return tuple(sorted(found))

    def __call__(self, text: str | None) -> tuple[int, ...]:
        return self.among(self.plain(text).split(" ")) if text else ()


# ---- J1: organisations.
def employer(names: list[Entry], suffixes: list[str]) -> Callable[[str | None], Entry | None]:
    """The entry of a name or alias, else of the name less one suffix."""
    known = {k: min(es, key=lambda e: _by(*(v for c, v in e.items() if c != "name_key"))) for k, es in _grouped(names, "name_key").items()}

    def of(name: str | None) -> Entry | None:
        plain = _fold(name or "")
        found = known.get(plain) if plain else None
        for s in suffixes:
            if found is not None:
                break
            if plain.endswith(s):
                found = known.get(plain[: -len(s)].strip(" ") or None)
        return found

    return of


def employer_step(kind: StructType, names: list[Entry], suffixes: list[str]):
    """(name) -> the organisation's columns."""

    def build():
        of = employer(names, suffixes)
        entries: dict[int, Entry] = {}

        def asked(name):
            entry = of(name)
            return None if entry is None else entries.setdefault(id(entry), entry) and id(entry)

        return asked, lambda key: None if key is None else entries[key]

    return step(kind, build)


# ---- J2: sources.
def source_step(kind: StructType, ways: list[Entry]):
    """(host, name) -> the source by its host or a parent domain, else by name, else by the platform's domain."""
    known = _grouped(ways, "key")
    fields = kind.names

    def answer(key):
        host, label = key
        parts = host.split(".")
        parents = [d for d in (".".join(parts[i:]) for i in range(len(parts))) if d]
        keys = [*("d:" + p for p in parents), *(["n:" + label] if label else []), *("p:" + p for p in parents)]
        found = [e for k in keys for e in known.get(k, ())]
        return min(found, key=lambda e: _by(e["stage"], e["nth"], *(e[c] for c in fields))) if found else None

    return step(kind, lambda: (lambda host, name: (host or "", _fold(name or "")), answer))


# ---- J4, J7: terms.
class Terms:
    """Up to limit distinct specialisations of raw terms: the source's own alias before a shared one, both before the taxonomy."""

    def __init__(self, ways: list[Entry], limit: int = 3) -> None:
        self.limit = limit
        self.known = {k: min(es, key=lambda e: _by(e["way"], e["target"]))["target"] for k, es in _grouped(ways, "probe").items()}

    def target(self, source: str, key: str) -> str | None:
        for probe in (f"ignored\x1f*\x1f{key}", f"ignored\x1f{source}\x1f{key}", f"source\x1f{source}\x1f{key}", f"source\x1f*\x1f{key}", f"taxonomy\x1f{key}"):
            if probe in self.known:
                return self.known[probe]
        return None

    def __call__(self, terms: list | None, source: str | None) -> tuple[str, ...]:
        if not terms:
            return ()
        source = _term("*" if source is None else source)
        return tuple(_distinct(_some(*[self.target(source, _term(t)) for t in terms if t])))[: self.limit]


def terms_step(kind: StructType, ways: list[Entry], parents: list[Entry]):
    """(terms, source) -> specialisations, and the first one's parent that isn't null."""

    def build():
        above = {t: min((e["parent"] for e in es if e["parent"] is not None), default=None) for t, es in _grouped(parents, "term").items()}
        return Terms(ways), lambda found: {"specialisations": list(found), "parent": next((above[t] for t in found if above.get(t) is not None), None)}

    return step(kind, build)


# ---- J12, J13, C11: places.
_END = r"(?:\r\n|[\n\r\u0085\u2028\u2029])?\Z"  # as Java's $


def _iso(sizes: str, more: str = "") -> Callable[[str], list[str]]:
    edge = rf"[ \t\n\x0b\f\r,;/()\[\]{more}-]"
    found = re.compile(rf"(?:^|{edge})([A-Z]{{{sizes}}})(?={_END}|{edge})").findall
    upper = re.compile("[A-Z]{2}").search
    return lambda raw: found(raw) if upper(raw) else []


class World:
    """The country by a code, an exact name, an upper-case code in the text, or the longest name in it."""

    def __init__(self, names: list[Entry], countries: list[Entry]) -> None:
        self.names = names
        self.phrases, self.iso = Phrases(names, "term", _unicode), _iso("2,3", "|")
        codes = [{"key": "c:" + c[f], "iso2": c["iso2"], "rank": 0} for c in countries for f in ("iso2", "iso3") if c[f] is not None]
        by_name = [{"key": "n:" + e["term"], "iso2": e["iso2"], "rank": e["rank"]} for e in names if e["term"] is not None]
        self.known = {k: min(es, key=lambda e: _by(e["rank"], e["iso2"]))["iso2"] for k, es in _grouped(codes + by_name, "key").items()}
        self.countries = {k: es[0] for k, es in _grouped(countries, "iso2").items()}

    def asked(self, raw: str | None, code: str | None, name: str | None, tokens: list[str] | None = None) -> str | None:
        """iso2 of what is found. tokens are those of the text, where they are known."""
        raw, name = raw or "", _unicode(name) if name else ""
        keys = [*(["c:" + code.upper()] if code is not None else []), *(["n:" + name] if name else []), *("c:" + t for t in self.iso(raw))]
        by_key = next((self.known[k] for k in keys if k in self.known), None)
        if by_key is not None:
            return by_key
        found = self.phrases(raw) if tokens is None else self.phrases.among(tokens)
        return min((self.names[p] for p in found), key=lambda e: _by(-len(e["term"]), e["rank"], e["iso2"]))["iso2"] if found else None

    def answer(self, iso2: str | None) -> Entry | None:
        return self.countries.get(iso2)


def world_step(kind: StructType, names: list[Entry], countries: list[Entry]):
    """(text, code, name) -> the country of the world."""

    def build():
        world = World(names, countries)
        return world.asked, world.answer

    return step(kind, build)


def place_step(kind: StructType, terms: list[Entry], names: list[Entry], countries: list[Entry], explicit: list[str]):
    """(text, country's name) -> loc: the African place, and where it has no code, the country of the world."""

    def build():
        world = World(names, countries)
        phrases, three, two = Phrases(terms, "term", _unicode), _iso("3"), _iso("2")
        african = [c for c in countries if c["is_african"]]
        states = {k: es[0] for k, es in _grouped(african, "iso2").items()}
        codes = [{"key": p + c[f], "iso2": c["iso2"], "rank": 0} for c in african for p, f in (("2:", "iso2"), ("3:", "iso3"), ("c:", "iso3"), ("c:", "iso2")) if c[f] is not None]
        by_name = [{"key": "n:" + e["term"], "iso2": e["iso2"], "rank": e["rank"]} for e in terms if e["kind"] == "country" and e["term"] is not None]
        known = {k: min(es, key=lambda e: _by(e["rank"], e["iso2"]))["iso2"] for k, es in _grouped(codes + by_name, "key").items()}
        sorted_terms = sorted(range(len(terms)), key=lambda p: _by(-len(terms[p]["term"] or ""), terms[p]["rank"], *(terms[p][c] for c in ("kind", "term", "alias", "iso2", "canonical", "lat", "lon"))))
        order = {p: i for i, p in enumerate(sorted_terms)}

        def asked(raw, country):
            text, name = (raw or "").strip(" "), _unicode(country) if country else ""
            own = [] if country is None else [("2:" + country.strip(" ").upper(), 2), ("3:" + country.strip(" ").upper(), 3)]
            keys = [*([("n:" + name, 1)] if name else []), *own, *(("c:" + t, 4) for t in (*three(text), *two(text)))]
            told = next(((known[k], at) for k, at in keys if k in known), None)
            tokens = _unicode(text).split(" ")
            return told, phrases.among(tokens), world.asked(raw, None, country, tokens), country

        def answer(key):
            told, places, elsewhere, country = key
            found = [terms[p] for p in sorted(places, key=order.__getitem__)]
            top = lambda es: es[0] if es else None
            of = lambda kind: [e for e in found if e["kind"] == kind]
            inside = lambda kind, code: [e for e in of(kind) if code is None or e["iso2"] == code]
            alone = lambda es, one: len({e["iso2"] for e in es if e["term"] == one["term"]}) == 1
            named = top(of("country"))
            code = told[0] if told and told[0] is not None else named and named["iso2"]
            how = explicit[told[1] - 1] if told else explicit[4] if named else None
            cities = inside("city", code)
            city = top(cities)
            if code is None and city and alone(cities, city):
                code, how = city["iso2"], "country_inferred_from_unique_city"
            admins = inside("admin", code)
            admin = top(admins)
            if code is None and admin and alone(admins, admin):
                code, how = admin["iso2"], "country_inferred_from_admin_area"
            region = top(of("region"))
            state = states.get(code) or {}
            sure = how in explicit
            confidence = 1.0 if sure and city else 0.96 if city and how == "country_inferred_from_unique_city" else 0.93 if sure else 0.86 if admin and code is not None else 0.68 if region else 0.0
            alias = city and city["alias"]
            if alias is None:
                alias = named["alias"] if how == explicit[4] else admin["alias"] if how == "country_inferred_from_admin_area" else code if how == "explicit_iso_code" else None
            loc = {
                "country_code": code, "country_iso3": state.get("iso3"), "country": country if state.get("name") is None else state["name"], "city": city and city["canonical"], "admin_area": admin and admin["canonical"],
                "region": state["region"] if state.get("region") is not None else region and region["canonical"], "lat": city and city["lat"], "lon": city and city["lon"], "confidence": confidence,
                "evidence": _some(how, city and "explicit_city_alias", admin and "explicit_admin_area", region and "explicit_region_alias"), "matched_alias": alias, "is_african": code is not None or region is not None, "known_non_african": False,
            }
            other = world.answer(elsewhere)
            if code is None and other is not None:
                loc |= {"country_code": other["iso2"], "country_iso3": other["iso3"], "country": other["name"], "is_african": other["is_african"], "confidence": max(confidence, 0.96)}
                if other["is_african"] is False:
                    loc |= {"region": "Non-Africa", "known_non_african": True}
            return loc

        return asked, answer

    return step(kind, build)


def nations_step(kind: DataType, terms: list[Entry]):
    """(text) -> codes of nationalities, then of countries, that it names; longer terms first."""

    def build():
        by = lambda p: _by(terms[p]["kind"] == "country", -len(terms[p]["term"]), terms[p]["rank"], terms[p]["iso2"])
        return Phrases(terms, "term", _unicode), lambda places: _distinct(terms[p]["iso2"] for p in sorted(places, key=by))

    return step(kind, build)


# ---- J9, J10, C12: families and themes.
def family_step(kind: StructType, families: list[Entry], allowed: list[str], themes: list[Entry]):
    """(specialisations, industry, whether it is an investment role, its canonical specialisation) -> role_family,
    role_subfamily, thematic_sectors."""

    def build():
        known = {k: min((e["family"] for e in es), key=_ordered) for k, es in _grouped(families, "key").items()}
        told = {k: [e["themes"] for e in sorted(es, key=lambda e: _ordered(e["themes"]))] for k, es in _grouped(themes, "key").items()}

        def flat(keys) -> list:
            found = [t for k in keys if k is not None for t in told.get(k, ())]
            return [] if None in found else [x for t in found for x in t]

        def answer(key):
            specialisations, industry, role, canonical = key
            first = specialisations[0] if specialisations else None
            keys = [*(["s:" + first] if first is not None else []), *(["i:" + industry] if industry is not None else [])]
            family = next((known[k] for k in keys if k in known), None)
            return {
                "role_family": "investment" if role else family if family in allowed else None, "role_subfamily": canonical if role and canonical is not None else first,
                "thematic_sectors": _distinct([*_distinct(flat([industry, *specialisations])), *(flat([canonical]) if role else [])]),
            }

        return lambda specialisations, industry, role, canonical: (tuple(specialisations or ()), industry, bool(role), canonical), answer

    return step(kind, build)


# ---- A20: the industry that a text names.
def industry_step(kind: DataType, keywords: dict[str, list[str]]):
    """(text in lower case) -> the industry with most keywords in it, ties to the first declared; null for none."""

    def asked(low):
        if not low:
            return None
        scores = [(sum([w in low for w in words]), -i) for i, words in enumerate(keywords.values())]
        best = max(scores)
        return list(keywords)[-best[1]] if best[0] else None

    return step(kind, lambda: (asked, lambda name: name))


# ---- C1, C2.
_TRACK = ("track_ord", "track", "classification", "canonical")


def _of_kind(entries: list[Entry], kind: str, *order: Callable[[Entry], object]) -> list[Entry]:
    return sorted((e for e in entries if e["kind"] == kind), key=lambda e: _by(*(o(e) for o in order), *(e[c] for c in (*_TRACK, "phrase"))))


def _of_list(entries: list[Entry], name: str) -> list[str]:
    return _distinct(e["phrase"] for e in sorted((e for e in entries if e["kind"] == name), key=lambda e: _by(e["ord"], e["phrase"])))


def _canonical(tracks: dict[str, list[Entry]], specialisations: tuple) -> list[Entry]:
    found = [e | {"phrase": e["canonical"]} for s in _distinct(specialisations) for e in tracks.get(s, ())]
    return sorted(found, key=lambda e: _by(e["track_ord"], e["canonical"], e["track"], e["classification"]))


def _by_track(**hits: list[Entry]) -> list[Entry]:
    every = _distinct(tuple(e[c] for c in _TRACK) for h in hits.values() for e in h)
    first = lambda h, ord: next((e["phrase"] for e in h if e["track_ord"] == ord), None)
    return [dict(zip(_TRACK, t, strict=True)) | {n: first(h, t[0]) for n, h in hits.items()} for t in every]


def investment_step(kind: StructType, taxonomy: dict, titles: list[Entry], contexts: list[Entry], tracks: list[Entry], names: list[Entry], suffixes: list[str], ways: list[Entry]):
    """(title, text beside it, employer, terms, source) -> investment_profile."""

    def build():
        in_title, in_body = Phrases(titles, "phrase", _word), Phrases(contexts, "phrase", _word)
        of_track, org, terms = _grouped(tracks, "canonical"), employer(names, suffixes), Terms(ways)
        fallback = next(t for t in taxonomy["tracks"] if t["id"] == taxonomy["fallback_track"])

        def asked(title, body, name, raw_terms, source):
            kind = (org(name) or {}).get("org_type")
            return in_title(title), in_body(body), terms(raw_terms, source), "unverified" if kind is None else kind

        def score(t: Entry) -> float:
            of_phrase = 0.0 if t["title_phrase"] is None else 0.88 + min(0.12, len(t["title_phrase"]) / 250.0)
            return (0.82 if t["spec"] is not None else 0.0) + of_phrase + (0.78 if t["title_context"] is not None else 0.0) + (0.42 if t["body_context"] is not None else 0.0)

        def answer(key):
            title, body, specialisations, org_type = key
            title, body = [titles[p] for p in title], [contexts[p] for p in body]
            found = _by_track(
                spec=_canonical(of_track, specialisations), title_phrase=_of_kind(title, "title", lambda e: -len(e["phrase"]), lambda e: e["ord"]),
                title_context=_of_kind(title, "context", lambda e: e["ord"]), body_context=_of_kind(body, "context", lambda e: e["ord"]),
            )
            parts = ("track", "classification", "canonical", "spec", "title_phrase", "title_context", "body_context")
            b = min(found, key=lambda t: _by(-score(t), t["track_ord"], *(t[c] for c in parts)), default=dict.fromkeys((*_TRACK, *parts)))
            best = score(b)
            absolute, hard, support, general = (_of_list(title, n) for n in ("absolute", "hard", "support", "generic"))
            generic = bool(general) and best < 0.75
            is_investment, is_dfi, is_finance = (org_type in taxonomy[k] for k in ("investment_types", "dfi_types", "finance_types"))
            prefixed = lambda prefix, c: None if b[c] is None else prefix + _under(b[c])
            own = _some(None if b["spec"] is None else "canonical_specialisation:" + b["spec"], prefixed("title_phrase:", "title_phrase"), prefixed("title_context:", "title_context"), prefixed("description_context:", "body_context"))
            track, classification, canonical = (fallback["id"], fallback["classification"], fallback["canonical"]) if generic else (b["track"], b["classification"], b["canonical"])
            evidence = ["generic_investment_title:" + _under(general[0])] if generic else own
            by_title = generic or b["title_phrase"] is not None or b["title_context"] is not None
            weak = not by_title and (generic or b["spec"] is None)
            institution = is_investment or is_dfi
            lifted = (0.82 if generic else best) + ((0.30 if weak else 0.08) if institution else 0.04 if is_finance else 0.0)
            role = track is not None and not (absolute or (hard and not by_title)) and not (weak and lifted < 0.55) and lifted >= 0.7
            if role:
                shown = _distinct([*evidence, *([f"institution_context:{org_type}"] if institution else [f"finance_institution_context:{org_type}"] if is_finance else [])])
            else:
                shown = [f"institution_context:{org_type}", *(["support_function:" + _under(support[0])] if support else [])] if institution else []
            against = ["non_investment_title:" + _under(p) for p in (*absolute, *hard)]
            if support and not role:
                against.append("support_function_title:" + _under(support[0]))
            if not role and any(s in taxonomy["non_investment_specialisations"] for s in specialisations):
                against.append("non_investment_finance_specialisation")
            return {
                "classification": classification if role else "institutional_support" if institution else "not_investment", "track": track if role else None, "canonical_specialisation": canonical if role else None,
                "confidence": _rounded(min(0.98, lifted) if role else (0.88 if support or hard else 0.72) if institution else 0.92 if hard else 0.78), "evidence": shown, "negative_evidence": _distinct(against),
                "dfi_relevance": "direct_investment" if is_dfi and role else "institutional_role" if is_dfi else "adjacent_experience" if role else "none",
                "dfi_confidence": 0.96 if is_dfi and role else 0.9 if is_dfi else 0.76 if role else 0.82, "is_investment_role": role,
            }

        return asked, answer

    return step(kind, build)


def ngo_step(kind: StructType, taxonomy: dict, titles: list[Entry], contexts: list[Entry], tracks: list[Entry]):
    """(title, summary, subfamily, industry, specialisations, kind of employer) -> ngo_profile."""

    def build():
        in_title, in_context, of_track = Phrases(titles, "phrase", _ngo), Phrases(contexts, "phrase", _ngo), _grouped(tracks, "canonical")

        def asked(title, summary, subfamily, industry, specialisations, org_type):
            return in_title(title), in_context(" ".join(_some(title, summary, subfamily, industry))), tuple(specialisations or ()), "unverified" if org_type is None else org_type

        def base(t: Entry) -> float:
            return 0.96 if t["title_phrase"] is not None else 0.82 if t["spec"] is not None else 0.0

        def uses_context(t: Entry) -> bool:
            return base(t) < 0.9 and t["context_phrase"] is not None

        def score(t: Entry) -> float:
            return base(t) + (0.24 if uses_context(t) else 0.0)

        def evidence(t: Entry) -> list[str]:
            return _some(
                None if t["spec"] is None else "canonical_specialisation:" + t["spec"], None if t["title_phrase"] is None else "title_phrase:" + _under(t["title_phrase"]),
                "context_phrase:" + _under(t["context_phrase"]) if uses_context(t) else None,
            )

        def answer(key):
            title, context, specialisations, org_type = key
            title, context = [titles[p] for p in title], [contexts[p] for p in context]
            found = _by_track(spec=_canonical(of_track, specialisations), title_phrase=_of_kind(title, "title", lambda e: e["ord"]), context_phrase=_of_kind(context, "context", lambda e: e["ord"]))
            b = min(found, key=lambda t: _by(-score(t), t["track_ord"], evidence(t), t["track"], t["classification"], t["canonical"]), default=None)
            negatives, supports = _of_list(title, "negatives"), _of_list(title, "supports")
            is_ngo, s = org_type in taxonomy["ngo_types"], score(b) if b else 0.0
            joins_in = is_ngo and s >= 0.45
            s = min(0.99, s + 0.05) if joins_in else s
            s = max(0.0, s - 0.45) if negatives and s < 0.9 else s
            s = max(0.0, s - 0.35) if supports and s < 0.9 else s
            s = min(0.99, max(0.0, s))
            programme = s >= 0.75 and b is not None and b["track"] is not None
            return {
                "is_ngo_or_un": is_ngo, "organisation_group": taxonomy["groups"].get(org_type, "ngo_or_development") if is_ngo else "other",
                "classification": b["classification"] if programme else "institutional_support" if is_ngo else "not_ngo_un", "track": b["track"] if programme else None, "canonical_specialisation": b["canonical"] if programme else None,
                "confidence": _rounded(s if programme else (0.82 if negatives or supports else 0.68) if is_ngo else 0.95),
                "evidence": _distinct([*evidence(b), *(["ngo_or_un_institution"] if joins_in else [])]) if programme else ["ngo_or_un_institution"] if is_ngo else [],
                "negative_evidence": _distinct([*("title_phrase:" + _under(p) for p in negatives), *("support_title:" + _under(p) for p in supports)]), "is_programme_role": programme,
            }

        return asked, answer

    return step(kind, build)


#: Types of the results.
LOC = "country_code:string,country_iso3:string,country:string,city:string,admin_area:string,region:string,lat:double,lon:double,confidence:double,evidence:array<string>,matched_alias:string,is_african:boolean,known_non_african:boolean"
INVESTMENT = "classification:string,track:string,canonical_specialisation:string,confidence:double,evidence:array<string>,negative_evidence:array<string>,dfi_relevance:string,dfi_confidence:double,is_investment_role:boolean"
NGO = "is_ngo_or_un:boolean,organisation_group:string,classification:string,track:string,canonical_specialisation:string,confidence:double,evidence:array<string>,negative_evidence:array<string>,is_programme_role:boolean"
