"""SQL for the queries that SQL can say, run by DuckDB on the same tables."""

from __future__ import annotations


# Written out here on their own, so that a slip in the operator's list shows.
_MISSING = ("-", "—", "–", ".", "..", "?", "??", "???", "n/a", "na", "null", "none", "nan", "nil", "tbd", "todo", "unknown", "untitled", "no title", "без названия", "нет", "нет данных", "неизвестно", "bez naziva", "nepoznato", "nema")


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _usable(v: str) -> str:
    """Whether a trimmed value says something."""
    nxt = "[\\x{80}-\\x{bf}\\x{20ac}\\x{201a}\\x{192}\\x{201e}\\x{2026}\\x{2020}\\x{2021}\\x{2c6}\\x{2030}\\x{160}\\x{2039}\\x{152}\\x{17d}\\x{2018}-\\x{201d}\\x{2022}\\x{2013}\\x{2014}\\x{2dc}\\x{2122}\\x{161}\\x{203a}\\x{153}\\x{17e}\\x{178}]"
    garbled = f"[\\x{{c2}}-\\x{{df}}]{nxt}|[\\x{{e0}}-\\x{{ef}}]{nxt}{nxt}|[\\x{{80}}-\\x{{9f}}]|\\x{{fffd}}|\\p{{Ll}}[ÐÑÂÃÄÅ]|(^|[^\\p{{L}}])Ä([aeo]|u([^ßg]|$))|(^|[^\\p{{L}}])â([^\\p{{L}}]|$)"
    cut = "(…|\\.\\.\\.|[\\[(](…|\\.\\.\\.)[\\])])\\s*$"
    return f"{v} <> '' AND lower({v}) NOT IN ({', '.join(map(_quoted, _MISSING))}) AND regexp_matches({v}, '[\\p{{L}}\\p{{N}}]{{2}}') AND NOT regexp_matches({v}, '{cut}') AND NOT regexp_matches({v}, '{garbled}')"


_SURE = "CASE dedupe_confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END"


def _best(table: str, key: str, group: str, field: str) -> str:
    """The usable value that is longest, newest and most trusted, per group."""
    return f"""SELECT {group} AS group_key, '{field}' AS field_name, arg_min({key}, (-length(v), -coalesce(epoch_us(last_seen_at_utc), -4611686018427387904), -({_SURE}), {key})) AS record_key
    FROM (SELECT *, trim(coalesce({field}, '')) AS v FROM {table} WHERE trim(coalesce({group}, '')) <> '')
    WHERE {_usable('v')} GROUP BY 1, 2"""


def _options(name: str, field: str, shared: str, typical: float, leading: bool = False) -> str:
    """CTE ``name`` (g, sh, trust, k): per group and shared value the most trusted usable value; of a leading field that dominates, it alone."""
    when = "coalesce(epoch_us(last_seen_at_utc), -4611686018427387904)"
    trust = f"greatest(0.0::DOUBLE, ({when} - 946684800000000) / 31557600000000.0::DOUBLE) * 0.2::DOUBLE + ({_SURE}) * 0.15::DOUBLE + length(v) / (length(v) + {typical}::DOUBLE)"
    whole = f", {name}_l AS (SELECT g, arg_max(v, {{'n': length(v), 'v': v}}) AS longest FROM {name}_u GROUP BY g)" if leading else ""
    kept = f"SELECT u.* FROM {name}_u u JOIN {name}_l USING (g) WHERE NOT (length(v) < length(longest) AND starts_with(longest, v))" if leading else f"SELECT * FROM {name}_u"
    best = f"{name}_b AS (SELECT g, sh, arg_min({{'k': k, 't': trust, 'n': n, 'w': w, 's': s}}, {{'t': -trust, 'n': -n, 'w': -w, 's': -s, 'k': k}}) AS x, max(n) AS n, max(w) AS w, max(s) AS s FROM {name}_k GROUP BY g, sh)"
    top = f"SELECT g, sh, x.t AS trust, x.k AS k, x.n = max(n) OVER (PARTITION BY g) AND x.w = max(w) OVER (PARTITION BY g) AND x.s = max(s) OVER (PARTITION BY g) AS top FROM {name}_b"
    only = f"SELECT g, sh, trust, k FROM (SELECT *, bool_or(top) OVER (PARTITION BY g) AS has, row_number() OVER (PARTITION BY g ORDER BY top DESC, trust DESC, k) AS rn FROM ({top})) WHERE NOT has OR rn = 1" if leading else f"SELECT g, sh, x.t AS trust, x.k AS k FROM {name}_b"
    return f"""{name}_u AS (SELECT g, k, v, sh, {trust} AS trust, length(v) AS n, {when} AS w, {_SURE} AS s FROM (SELECT *, offer_merge_override_group AS g, offer_key AS k, trim(coalesce(CAST({field} AS VARCHAR), '')) AS v, coalesce(CAST({shared} AS VARCHAR), '') AS sh FROM offers WHERE trim(coalesce(offer_merge_override_group, '')) <> '' AND offer_key IS NOT NULL) WHERE {_usable('v')}){whole},
    {name}_k AS ({kept}), {best}, {name} AS ({only})"""


def merged_offers() -> str:
    """p1_merged_offers: title and category, price text and amounts are chosen together over all their combinations."""
    pair = lambda n, a, b, w: f"""{n} AS (SELECT g, arg_min({{'a': a, 'b': b}}, {{'f': -f, 't': -t, 'a': coalesce(a, ''), 'b': coalesce(b, '')}}) AS x FROM (
      SELECT {a}.g, {a}.k AS a, {b}.k AS b, 2 AS f, {w} * {a}.trust + {b}.trust AS t FROM {a} JOIN {b} ON {a}.g = {b}.g AND {a}.sh = {b}.sh UNION ALL SELECT g, k, NULL, 1, {w} * trust FROM {a} UNION ALL SELECT g, NULL, k, 1, trust FROM {b}) GROUP BY g)"""  # noqa: E731
    return f"""WITH {_options('ti', 'title_best', 'category_primary', 40, True)}, {_options('de', 'description_best', "''", 200, True)}, {_options('ca', 'category_primary', 'category_primary', 10)},
    {_options('pr', 'price_text_best', 'currency_code', 10)}, {_options('am', 'price_min', 'currency_code', 5)},
    {pair('tc', 'ti', 'ca', '2.0::DOUBLE')}, {pair('pa', 'pr', 'am', '1.0::DOUBLE')},
    d AS (SELECT g, arg_min(k, {{'t': -trust, 'k': k}}) AS k FROM de GROUP BY g), gs AS (SELECT g FROM tc UNION SELECT g FROM pa UNION SELECT g FROM d)
    SELECT gs.g AS group_key, t.title_best, e.description_best, e.offer_summary, c.category_primary, c.category_secondary, p.price_text_best, a.price_min, a.price_max, a.currency_code
    FROM gs LEFT JOIN tc USING (g) LEFT JOIN pa USING (g) LEFT JOIN d USING (g) LEFT JOIN offers t ON t.offer_key = tc.x.a LEFT JOIN offers c ON c.offer_key = tc.x.b LEFT JOIN offers e ON e.offer_key = d.k LEFT JOIN offers p ON p.offer_key = pa.x.a LEFT JOIN offers a ON a.offer_key = pa.x.b"""


def best_fields() -> str:
    """p1_found."""
    offers = [_best("offers", "offer_key", "offer_merge_override_group", f) for f in ("title_best", "description_best")]
    return " UNION ALL ".join([*offers, _best("providers", "provider_key", "provider_merge_override_group", "display_name_best")])


def provider_groups() -> str:
    """p5_found: the closure over pairs of links."""
    phone = r"(?:\+|00)381(?:[ ()/-]{0,2}\d){8,9}|\(?0[1-9]\d?\)?(?:[ /-]{0,2}\d){6,7}"
    return f"""WITH RECURSIVE ph AS (SELECT provider_key AS k, regexp_replace(unnest(regexp_extract_all(coalesce(phones, ''), '{phone}')), '[^0-9]', '', 'g') AS d FROM providers),
    items AS (SELECT k, 'p' || CASE WHEN d LIKE '00%' THEN d[3:] WHEN d LIKE '0%' THEN '381' || d[2:] ELSE d END AS i FROM ph
      UNION SELECT provider_key, 'h' || unnest(regexp_extract_all(replace(replace(lower(coalesce(telegram_handles, '')), 'https://', ''), 't.me/', ' '), '[a-z0-9_]{{4,}}')) FROM providers),
    e AS (SELECT DISTINCT a.k AS a, b.k AS b FROM items a JOIN items b ON a.i = b.i AND a.k <> b.k
      UNION SELECT left_provider_key, right_provider_key FROM provider_matches WHERE decision = 'match' AND left_provider_key <> right_provider_key
      UNION SELECT right_provider_key, left_provider_key FROM provider_matches WHERE decision = 'match' AND left_provider_key <> right_provider_key),
    r AS (SELECT a, a AS c FROM e UNION SELECT e.a, r.c FROM e JOIN r ON r.a = e.b)
    SELECT a AS provider_key, min(c) AS group_key FROM r GROUP BY a"""


# The oracle's own tables of what looks the same, apart from the operator's.
_OTHER = "АВЕЅІЈКМНОРСТУҮХԚԜԌѴӀаеѕіјорсухһԁԛԝѵүӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧοναρЀЁЇѐёї"
_LATIN = "ABESIJKMHOPCTYYXQWGVIaesijopcyxhdqwvylABEZHIKMNOPTYXovapÈËÏèëï"
_GONE = "[\u00ad\u034f\u061c\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff]"
_BLANKS = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000\t"


def _alike(c: str) -> str:
    """The text without what cannot be seen and in one writing of each letter; twice, as marks join their letters between."""
    wide = "".join(map(chr, range(0xFF01, 0xFF5F)))
    src, dst = _OTHER + wide + _BLANKS + "\r\x0b\x0c\x85\u2028\u2029", _LATIN + "".join(chr(ord(x) - 0xFEE0) for x in wide) + " " * len(_BLANKS) + "\n" * 6
    one = lambda x: f"translate({x}, {_quoted(src)}, {_quoted(dst)})"
    bare = f"regexp_replace(replace({c}, chr(13) || chr(10), chr(10)), {_quoted(_GONE)}, '', 'g')"
    return one(f"nfc_normalize({one(f'nfc_normalize({bare})')})")


def leaked_items(least: int = 13) -> str:
    """p9_found: runs of words in both texts; each letter goes by its capital, whose look-alike is then made small."""
    text = f"lower(translate(upper({_alike('coalesce(text, ' + _quoted('') + ')')}), {_quoted(_OTHER)}, {_quoted(_LATIN)}))"
    grams = lambda t, k: f"(SELECT DISTINCT {k}, array_to_string(w[i:i + {least - 1}], ' ') AS g FROM (SELECT {k}, w, unnest(range(1, len(w) - {least - 2})) AS i FROM (SELECT {k}, regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}]+') AS w FROM {t})))"
    return f"SELECT DISTINCT doc_id, item_id FROM {grams('documents', 'doc_id')} d JOIN {grams('eval_items', 'item_id')} e ON d.g = e.g"


def _looks() -> str:
    form = lambda c: f"regexp_replace({_alike(c)}, ' +(\\n|$)', '\\1', 'g')"
    rows = lambda t, k, c: f"SELECT DISTINCT '{t}.{c}' AS f, {k} AS k, {c} AS raw, {form(c)} AS look FROM {t} WHERE {k} IS NOT NULL AND coalesce({c}, '') <> ''"
    return f"SELECT * FROM ({rows('raw_posts', 'post_key', 'text')} UNION ALL {rows('providers', 'provider_key', 'canonical_name')}) WHERE trim(look, chr(10) || ' ') <> ''"


def look_alikes() -> str:
    """p3_found: pairs within equal forms."""
    return f"WITH x AS ({_looks()}) SELECT DISTINCT a.f AS field_name, a.k AS key_a, b.k AS key_b FROM x a JOIN x b ON a.f = b.f AND a.look = b.look AND a.k < b.k AND a.raw <> b.raw"


def look_alike_classes() -> str:
    """p3_classes: links counted pair by pair."""
    return f"""WITH x AS ({_looks()}), low AS (SELECT f, look, min(k) AS class_key FROM x GROUP BY f, look)
    SELECT a.f AS field_name, a.k AS record_key, class_key, count(*) AS links FROM x a JOIN x b ON a.f = b.f AND a.look = b.look AND a.k <> b.k AND a.raw <> b.raw
    JOIN low ON low.f = a.f AND low.look = a.look GROUP BY a.f, a.k, a.look, class_key"""


def clean_documents() -> str:
    """p9_clean_documents."""
    return f"SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({leaked_items()}))"


SQL = {"p1_found": best_fields(), "p1_merged_offers": merged_offers(), "p3_found": look_alikes(), "p3_classes": look_alike_classes(), "p5_found": provider_groups(), "p9_found": leaked_items(), "p9_clean_documents": clean_documents()}
