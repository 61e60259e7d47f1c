"""SQL for what is read from post texts: contacts, identity, prices, categories, structured posts and their clusters.

Written on its own: patterns are put as SQL engines without look-around need them, word lists are spelled out again.
"""

from __future__ import annotations

_NORM = r"""trim(regexp_replace(regexp_replace(translate(regexp_replace(coalesce({c}, ''), '([0-9])\x{{fe0f}}\x{{20e3}}', '\1', 'g'), '⓪①②③④⑤⑥⑦⑧⑨٠١٢٣٤٥٦٧٨٩', '01234567890123456789'), '[\x{{200b}}-\x{{200f}}\x{{2060}}\x{{feff}}]', '', 'g'), '[\t-\r\x1c-\x20\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g'))"""
norm = lambda c: _NORM.format(c=c)

_BLANK = r"\t\n\x{b}\f\r "
_PHONE = rf"\+?[0-9][0-9{_BLANK}()\-]{{7,}}[0-9]"
_SAID_PHONE = r"(?i)(?:telefon:|whatsapp|telefon|phone|viber|tel|тел|mob|wa)[: \-]*(\+?[0-9][0-9 \-()]{6,}[0-9])"
_SAID_HANDLE = r"(?i)(?:telegram|телеграм|телега|t\.me|tg)[: \-]*(@?[A-Za-z0-9_]{4,})"
_HANDLE = r"(?:^|[^\p{L}\p{N}\p{M}_])(@[A-Za-z0-9_]{4,})"

digits = lambda c: f"CASE WHEN length(regexp_replace({norm(c)}, '[^0-9]', '', 'g')) >= 8 THEN regexp_replace({norm(c)}, '[^0-9]', '', 'g') ELSE '' END"


def handle(c: str) -> str:
    v = f"regexp_replace(lower({norm(c)}), '^@', '')"
    v = f"CASE WHEN regexp_matches({v}, '^https?://') THEN trim(regexp_replace(regexp_replace({v}, '^https?://[^/?#]*', ''), '[?#].*$', ''), '/') ELSE {v} END"
    return f"trim(split_part({v}, '/', 1), ' .,:;')"


def url(c: str) -> str:
    v = f"trim({norm(c)}, '.,);]')"
    scheme = "^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]+)"
    return f"CASE WHEN regexp_matches({v}, '{scheme}') THEN lower(regexp_extract({v}, '{scheme}', 1)) || regexp_replace(regexp_extract({v}, '{scheme}([^?#]*)', 2), '/+$', '') ELSE lower({v}) END"


def contacts(base: str) -> str:
    """CTEs ``b`` (rid, r, n and the columns of ``base``, a relation with ``txt``) and ``cm`` (rid, kind, value, pass_no), each contact once."""
    every = lambda t, pattern, group=0: f"unnest(regexp_extract_all({t}, '{pattern}', {group}))"
    found = [
        ("phone", every("t", _PHONE), digits("x"), ""), ("email", every("t", r"\b[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}\b"), "lower(x)", ""),
        ("telegram_link", every("t", r"(?i)https?://t\.me/[A-Za-z0-9_+/]+"), url("x"), ""), ("telegram_handle", every("t", _HANDLE, 1), handle("x"), ""),
        ("website", every("t", rf"(?i)https?://[^{_BLANK}<>()]+"), f"regexp_replace(regexp_replace({url('x')}, '^[a-z][a-z0-9+.\\-]*://', ''), '^www\\.|/+$', '', 'g')", "WHERE NOT (contains(lower(x), 't.me/') OR contains(lower(x), 'instagram.com/') OR contains(lower(x), 'facebook.com/') OR contains(lower(x), 'wa.me/'))"),
    ]
    rows = [f"SELECT rid, pass_no, '{k}' AS kind, {v} AS value FROM (SELECT rid, pass_no, {x} AS x FROM p) {w}" for k, x, v, w in found]
    rows += [f"SELECT rid, 3, 'phone', {digits('x')} FROM (SELECT rid, {every('n', _SAID_PHONE, 1)} AS x FROM b)", f"SELECT rid, 3, 'telegram_handle', {handle('x')} FROM (SELECT rid, {every('n', _SAID_HANDLE, 1)} AS x FROM b)"]
    return f"""b AS (SELECT row_number() OVER () AS rid, *, coalesce(txt, '') AS r, {norm('txt')} AS n FROM {base}),
    p AS (SELECT rid, 1 AS pass_no, r AS t FROM b UNION ALL SELECT rid, 2, n FROM b WHERE r <> n),
    cm AS (SELECT rid, kind, value, min(pass_no) AS pass_no FROM ({' UNION ALL '.join(rows)}) WHERE value <> '' GROUP BY 1, 2, 3)"""


def contact_matches() -> str:
    return f"WITH {contacts('(SELECT post_key, text AS txt FROM raw_posts)')} SELECT kind, value, count(*) AS n, count(DISTINCT post_key) AS posts, min(pass_no) AS pass_no FROM cm JOIN b USING (rid) GROUP BY 1, 2"


_CATEGORIES = {
    "auto_service": ("шиномонтаж", "автосервис", "замена масла", "полировк", "zamena guma", "diagnost"), "beauty_hair": ("барбер", "парикмах", "стриж", "окраш", "šišanje", "haircut"),
    "beauty_nails": ("маникюр", "педикюр", "ногт", "manikir", "manicure", "nail"), "cleaning": ("уборк", "клининг", "химчист", "мытьё окон", "čišćenje", "cleaning"),
    "home_repair": ("ремонт", "сантех", "электр", "плитк", "покраск", "krečenje", "tiling"), "it_digital": ("таргет", "smm", "дизайн", "сайт", "разработ", "маркетинг", "frontend", "backend"),
    "pets": ("собак", "кошк", "ветерин", "грум", "pet"), "transport": ("переезд", "доставк", "трансфер", "selidb", "moving", "transfer"),
}
_VETOES = {"it_digital": ("дизайнерский ремонт",), "auto_service": ("автопарк",)}
_CURRENCY = "(?:€|\\$|eur|euro|rsd|din|usd|dinar|дин|евро)"
_WORDS = "цена|стоимость|price|from|от"
_STOPWORDS = "и в на с по для из от до за the and for with a an of to in on или как мы вы это все our you we".split()


def _structured() -> str:
    """CTEs up to ``sp``, one row per row of raw_posts with every signal as text."""
    base = """(SELECT *, CASE WHEN trim(coalesce(text, '')) <> '' THEN text WHEN trim(coalesce(text_normalized, '')) <> '' THEN text_normalized ELSE '' END AS txt FROM raw_posts)"""
    score = lambda t: "[" + ", ".join(f"{{'code': '{c}', 'score': " + " + ".join(f"contains({t}, '{w}')::INT" for w in ws) + "".join(f" - contains({t}, '{v}')::INT" for v in _VETOES.get(c, ())) + "}" for c, ws in _CATEGORIES.items()) + "]"
    edge = "regexp_replace({t}, '(?i)(^|[^\\p{{L}}\\p{{N}}_\\x01\\x02])(" + _WORDS + ")([^\\p{{L}}\\p{{N}}_\\x01\\x02]|$)', '\\1\x01\\2\x02\\3', 'g')"
    marked = edge.format(t=edge.format(t="n"))
    num = rf"[0-9][0-9{_BLANK}.,]*"
    price = rf"(?i)€[{_BLANK}]*{num}|\$[{_BLANK}]*{num}|{num}{_CURRENCY}|\x01(?:цена|стоимость|price)\x02[:{_BLANK}]*{num}{_CURRENCY}?|\x01(?:from|от)\x02[:{_BLANK}]*{num}{_CURRENCY}|[0-9]{{1,3}}%"
    stop = ", ".join(f"'{w}'" for w in _STOPWORDS)
    plain = lambda x: f"replace(replace({x}, chr(1), ''), chr(2), '')"
    said = lambda x: f"(contains(lower({x}), 'цена') OR contains(lower({x}), 'стоимость') OR contains(lower({x}), 'price'))"
    return f"""WITH {contacts(base)},
    h1 AS (SELECT rid, list_filter({score('lower(n)')}, lambda s: s.score > 0) AS own, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(n, '#([A-Za-zЀ-ӿ0-9_]{{3,}})', 1), lambda x: lower(x)))), ' ') AS tags FROM b),
    h2 AS (SELECT rid, CASE WHEN len(own) > 0 THEN own ELSE list_filter({score('tags')}, lambda s: s.score > 0) END AS s FROM h1),
    h3 AS (SELECT rid, s, list_max(list_transform(s, lambda x: x.score)) AS top FROM h2),
    h AS (SELECT rid, string_agg(code || ':' || score || ':' || CASE WHEN score >= 3 THEN 'high' WHEN score = 2 THEN 'medium' ELSE 'low' END, '|' ORDER BY score DESC, code) AS hints, list(code) AS codes FROM (SELECT rid, top, unnest(s).code AS code, unnest(s).score AS score FROM h3) WHERE top < 2 OR (score >= top - 1 AND score >= 2) GROUP BY rid),
    pm AS (SELECT rid, {plain("trim(unnest(regexp_extract_all(" + marked + ", '" + price + "')))")} AS v FROM b WHERE regexp_matches(n, '[0-9]')),
    pl AS (SELECT rid, {norm('l')} AS v FROM (SELECT rid, unnest(regexp_split_to_array(r, '[\\r\\n|]+')) AS l FROM b WHERE rid NOT IN (SELECT rid FROM pm))),
    pr AS (SELECT rid, list_sort(list_distinct(list(v))) AS prices FROM (SELECT rid, v FROM pm UNION ALL SELECT rid, substr(v, 1, 80) FROM pl WHERE {said('v')} AND regexp_matches(v, '[0-9]')) GROUP BY rid),
    ct AS (SELECT rid, CASE WHEN contains(t, 'белград') OR contains(t, 'belgrade') OR contains(t, 'beograd') THEN 'belgrade' WHEN contains(t, 'нови сад') OR contains(t, 'novi sad') THEN 'novi_sad' WHEN contains(t, 'ниш') OR contains(t, 'niš') OR contains(t, 'nis') THEN 'nis' WHEN contains(t, 'суботица') OR contains(t, 'subotica') THEN 'subotica' ELSE '' END AS city FROM (SELECT rid, lower(n) AS t FROM b)),
    tk AS (SELECT rid, list_sort(list_distinct(list_filter(regexp_extract_all(lower(n), '[0-9a-zа-яё]+'), lambda w: length(w) >= 3 AND NOT regexp_matches(w, '^[0-9]+$') AND w NOT IN ({stop})))) AS tokens FROM b),
    cs AS (SELECT rid, {', '.join(f"coalesce(string_agg(value, '|' ORDER BY value) FILTER (kind = '{k}'), '') AS {k}" for k in ('phone', 'email', 'telegram_handle', 'telegram_link', 'website'))}, list(CASE kind WHEN 'phone' THEN 'phone:' WHEN 'email' THEN 'email:' WHEN 'telegram_handle' THEN 'tg:' WHEN 'telegram_link' THEN 'tg_link:' ELSE 'site:' END || value) AS keys FROM cm GROUP BY rid),
    sp AS (SELECT b.rid, CASE WHEN coalesce(post_key, '') <> '' THEN post_key WHEN chat_id IS NOT NULL AND message_id IS NOT NULL THEN 'tg:' || chat_id || ':' || message_id ELSE '' END AS raw_post_id,
      CASE WHEN trim(coalesce(_telegram_target_resolved, '')) <> '' THEN lower(_telegram_target_resolved) WHEN trim(coalesce(chat_title, '')) <> '' THEN lower(chat_title) WHEN trim(coalesce(chat_id, '')) <> '' THEN chat_id ELSE '' END AS source_channel_key,
      posted_at_utc, _run_id, r AS text_raw, n AS text_norm, sha1(lower(n)) AS text_hash, coalesce(phone, '') AS phones, coalesce(email, '') AS emails, coalesce(telegram_handle, '') AS handles, coalesce(telegram_link, '') AS links, coalesce(website, '') AS websites,
      coalesce(hints, '') AS hints, coalesce(codes, []) AS codes, city, coalesce(array_to_string(prices, '|'), '') AS prices,
      concat_ws('|', CASE WHEN regexp_matches(lower(array_to_string(prices, ' ')), '€|eur|евро') THEN 'eur' END, CASE WHEN regexp_matches(lower(array_to_string(prices, ' ')), 'rsd|din|дин') THEN 'rsd' END, CASE WHEN regexp_matches(lower(array_to_string(prices, ' ')), '\\$|usd') THEN 'usd' END) AS currencies,
      list_sort(list_distinct(list_concat(coalesce(keys, []), list_filter([CASE WHEN {handle('sender_username')} <> '' THEN 'tg:' || {handle('sender_username')} ELSE '' END, CASE WHEN {url('sender_profile_url')} <> '' THEN 'tg_link:' || {url('sender_profile_url')} ELSE '' END, 'weak_text:' || sha1(lower(n))], lambda x: x <> '')))) AS ids,
      concat_ws('|', CASE WHEN has_media THEN 'has_media' END, CASE WHEN keys IS NOT NULL THEN 'has_contacts' END, CASE WHEN hints IS NOT NULL THEN 'has_role_hints' END, CASE WHEN city <> '' THEN 'has_city' END, CASE WHEN len(prices) > 0 THEN 'has_price' END) AS flags,
      tokens, sender_id, sender_kind, sender_title, trim(coalesce(sender_username, '')) AS sender_username, trim(coalesce(sender_profile_url, '')) AS sender_profile_url, trim(coalesce(post_author, '')) AS post_author
      FROM b LEFT JOIN cs USING (rid) LEFT JOIN h USING (rid) LEFT JOIN pr USING (rid) LEFT JOIN ct USING (rid) LEFT JOIN tk USING (rid))"""


def structured_posts() -> str:
    return f"{_structured()} SELECT * EXCLUDE (rid, codes, ids, tokens), array_to_string(ids, '|') AS identity, coalesce(array_to_string(tokens, '|'), '') AS tokens FROM sp"


def provider_clusters() -> str:
    """Posts by the closure of shared strong keys, each set named by its smallest strong key."""
    return f"""{_structured().replace('WITH b AS', 'WITH RECURSIVE b AS', 1)},
    po AS (SELECT raw_post_id, max(ids) AS ids, max(list_filter(ids, lambda x: NOT starts_with(x, 'weak_text:'))) AS strong FROM sp WHERE raw_post_id <> '' GROUP BY 1),
    k AS (SELECT raw_post_id, unnest(strong) AS k FROM po), lo AS (SELECT raw_post_id, min(k) AS least FROM k GROUP BY 1),
    e AS (SELECT DISTINCT x.k AS a, least AS b FROM k x JOIN lo USING (raw_post_id) WHERE x.k <> least), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    c AS (SELECT DISTINCT k AS a, k AS c FROM k UNION SELECT s.a, c.c FROM s JOIN c ON c.a = s.b),
    of AS (SELECT a, min(c) AS anchor FROM c GROUP BY 1)
    SELECT raw_post_id, 'provider:' || split_part(anchor, ':', 1) || ':' || sha1(anchor) AS provider_key FROM lo JOIN of ON of.a = least
    UNION ALL SELECT raw_post_id, 'provider:raw_post:' || sha1(coalesce(ids[1], raw_post_id)) FROM po WHERE len(strong) = 0"""


def _shorten(c: str, limit: int) -> str:
    head = f"substr({c}, 1, {limit})"
    cuts = "greatest(" + ", ".join(f"{limit} - length(list_extract(string_split({head}, '{s}'), -1))" for s in ("; ", ", ", ". ", " ")) + ")"
    return f"CASE WHEN length({c}) <= {limit} THEN {c} ELSE trim(CASE WHEN {cuts} >= {max(24, limit // 3)} THEN rtrim(substr({head}, 1, CAST({cuts} AS BIGINT))) ELSE {head} END, ' ;,.') END"


def fact_packs() -> str:
    """Title, details and quality from cleaned lines."""
    low = "lower(x)"
    words = "len(string_split(trim(x), ' '))"
    noise = (
        rf"(NOT regexp_matches(x, '[\p{{L}}\p{{N}}]') OR regexp_matches({low}, '^(#[^{_BLANK}]+[{_BLANK}]*)+$') OR ({words} <= 5 AND regexp_replace({low}, '[{_BLANK}:.!\-]+$', '') IN ('услуги', 'контакты', 'цены', 'прайс', 'services', 'contacts', 'prices', 'usluge', 'cene'))"
        + "".join(f" OR contains({low}, '{w}')" for w in ("подписывайтесь", "репост", "розыгрыш", "акция только", "subscribe", "giveaway", "zapratite"))
        + rf" OR ({words} <= 4 AND regexp_matches(x, '\p{{L}}') AND upper(x) = x) OR ({words} < 2 AND regexp_matches(x, '[\x{{1F300}}-\x{{1FAFF}}\x{{2600}}-\x{{27BF}}]')))"
    )
    greets = "('привет', 'всем привет', 'здравствуйте', 'добрый день', 'hi all', 'hello', 'zdravo', 'dobar dan')"
    return rf"""WITH t AS (SELECT post_key, _run_id, coalesce(text, '') AS t FROM raw_posts),
    s AS (SELECT post_key, _run_id, regexp_split_to_array(t, '[\r\n]+') AS a, regexp_split_to_array(t, '[{_BLANK}]*[•●▪][{_BLANK}]*') AS b, string_split(regexp_replace(t, '([.!?])[{_BLANK}]+', '\1' || chr(1), 'g'), chr(1)) AS c FROM t),
    l AS (SELECT post_key, _run_id, list_filter(list_transform(CASE WHEN len(a) > 1 THEN a WHEN len(b) > 1 THEN b ELSE c END, lambda x: {norm('x')}), lambda x: x <> '') AS l FROM s),
    k AS (SELECT post_key, _run_id, list_filter(list_transform(l, lambda x: trim(regexp_replace(x, '^[^\p{{L}}\p{{N}}+@#«"(]+|[{_BLANK}\-–—•]+$', '', 'g'))), lambda x: x <> '' AND NOT {noise} AND regexp_replace(lower(x), '[!.,{_BLANK}]+$', '') NOT IN {greets}) AS k FROM l),
    u AS (SELECT post_key, _run_id, list_filter(k, lambda x, i: list_position(list_transform(k, lambda y: lower(y)), lower(x)) = i) AS k FROM k),
    v AS (SELECT post_key, _run_id, coalesce(k[1], '') AS a, array_to_string(k[2:4], '; ') AS b, len(k) AS n FROM u)
    SELECT post_key, _run_id, {_shorten('a', 120)} AS title, {_shorten('b', 280)} AS details, CASE WHEN n = 0 THEN 'weak_signal' WHEN n = 1 THEN 'title_only' ELSE 'clean' END AS quality FROM v"""


def offer_clusters() -> str:
    """Within a provider: one text, similar words with agreeing categories, and posts without content by channel and time."""
    clusters = provider_clusters()
    at = clusters.index("SELECT raw_post_id, 'provider:' ||")
    return rf"""{clusters[:at].rstrip()}, pc AS ({clusters[at:]}),
    o AS (SELECT raw_post_id, arg_max({{'h': text_hash, 't': tokens, 'c': codes, 'ch': source_channel_key, 'p': posted_at_utc}}, {{'a': text_norm <> '', 'b': try_cast(trim(posted_at_utc) AS TIMESTAMPTZ) IS NOT NULL, 'c': source_channel_key <> '', 'd': _run_id, 'e': text_hash, 'f': posted_at_utc, 'g': source_channel_key}}) AS x FROM sp WHERE raw_post_id <> '' GROUP BY 1),
    r0 AS (SELECT raw_post_id AS id, provider_key AS g, x.h AS h, coalesce(x.t, []) AS t, x.c AS c, coalesce(x.ch, '') AS ch, trim(coalesce(x.p, '')) AS at_text, try_cast(trim(coalesce(x.p, '')) AS TIMESTAMPTZ) AS ts, coalesce(x.h, '') IN ('', sha1('')) AS blank FROM o JOIN pc USING (raw_post_id)),
    rr AS (SELECT *, blank AND len(t) = 0 AND len(c) = 0 AS bare FROM r0),
    lw AS (SELECT g, h, min(id) AS b FROM rr WHERE NOT blank GROUP BY 1, 2),
    rp AS (SELECT * FROM rr WHERE len(t) > 0 AND (id IN (SELECT b FROM lw) OR (blank AND NOT bare))),
    nr AS (SELECT a.id AS a, b.id AS b FROM rp a JOIN rp b ON a.g = b.g AND a.id < b.id WHERE (len(a.c) = 0 OR len(b.c) = 0 OR len(list_intersect(a.c, b.c)) > 0) AND len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) >= 0.55),
    ba AS (SELECT * FROM rr WHERE bare AND ch <> ''), tl AS (SELECT * FROM rr WHERE NOT bare),
    st AS (SELECT *, lag(id) OVER w IS NULL OR coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w), 0) > 5000000 AS is_first FROM ba WINDOW w AS (PARTITION BY g, ch, CASE WHEN ts IS NULL THEN at_text END ORDER BY ts, id)),
    hd AS (SELECT *, last_value(CASE WHEN is_first THEN id END IGNORE NULLS) OVER (PARTITION BY g, ch, CASE WHEN ts IS NULL THEN at_text END ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS head FROM st),
    mt AS (SELECT hd.head, tl.id AS b, CASE WHEN hd.ts IS NULL THEN 0 ELSE abs(epoch_us(hd.ts) - epoch_us(tl.ts)) END AS gap, coalesce(epoch_us(tl.ts), 0) AS at_us FROM hd JOIN tl ON hd.g = tl.g AND hd.ch = tl.ch WHERE (hd.ts IS NULL AND tl.ts IS NULL AND hd.at_text = tl.at_text) OR abs(epoch_us(hd.ts) - epoch_us(tl.ts)) <= 5000000),
    hg AS (SELECT head AS a, arg_min(b, {{'g': gap, 't': at_us, 'b': b}}) AS b FROM mt GROUP BY 1),
    ed AS (SELECT rr.id AS a, lw.b FROM rr JOIN lw ON rr.g = lw.g AND rr.h = lw.h WHERE NOT rr.blank UNION SELECT a, b FROM nr UNION SELECT id, head FROM hd UNION SELECT a, b FROM hg),
    sy AS (SELECT a, b FROM ed UNION SELECT b, a FROM ed),
    cl AS (SELECT id AS a, id AS c FROM rr UNION SELECT sy.a, cl.c FROM sy JOIN cl ON cl.a = sy.b),
    nm AS (SELECT a, min(c) AS c FROM cl GROUP BY 1)
    SELECT id AS raw_post_id, g AS provider_key, 'offer:' || sha1(g || chr(31) || nm.c) AS offer_key FROM rr JOIN nm ON nm.a = id"""
