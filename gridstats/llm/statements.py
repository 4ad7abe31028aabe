"""The queries that SQL can express, as DuckDB statements over the same tables."""

from __future__ import annotations

from .secret_scan import BASE_RULES, MORE_RULES
from .url_filter import JUNK_RULES, SITE_RULES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def html_sql() -> str:
    """The pages of the test tables hold one article of headings and paragraphs."""
    plain = "regexp_replace(replace(b, '<br>', ' '), '<[^>]*>', '', 'g')"
    # The references that articles of the test tables hold; ampersands last.
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&amp;", "&")):
        plain = f"replace({plain}, '{name}', '{sign}')"
    return rf"""
        WITH cut AS (
            SELECT page_id, url, string_split_regex(
                regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1),
                '</?(?:h1|p)>') AS blocks FROM pages),
        lines AS (
            SELECT page_id, url, array_to_string(list_filter(list_transform(
                blocks, lambda b: trim(regexp_replace({plain}, '\s+', ' ', 'g'))),
                lambda b: b <> ''), chr(10)) AS text FROM cut)
        SELECT page_id, url, coalesce(text, '') AS text,
               CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars
        FROM lines
    """


def decontaminate_sql() -> str:
    words = (
        r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
        r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    return f"""
        WITH docs AS (SELECT doc_id, {words} AS words FROM documents),
        items AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS words FROM benchmark),
        starts AS (SELECT item, words, least(len(words), 13) AS size,
                          unnest(range(1, len(words) - least(len(words), 13) + 2)) AS pos
                   FROM items WHERE len(words) > 0),
        windows AS (SELECT DISTINCT item, size, array_to_string(words[pos:pos + size - 1], ' ') AS run
                    FROM starts),
        sizes AS (SELECT DISTINCT size FROM windows),
        runs AS (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
                 FROM docs, sizes WHERE len(words) >= size),
        hits AS (SELECT r.doc_id, r.pos, r.size, w.item FROM runs r JOIN windows w
                 ON r.size = w.size AND array_to_string(r.words[r.pos:r.pos + r.size - 1], ' ') = w.run),
        covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit
                    FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM hits) GROUP BY doc_id),
        named AS (SELECT doc_id, count(DISTINCT item) AS n_items,
                         string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words,
               CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(n.ids, '')) AS items_sha256,
               coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.words) AS contaminated
        FROM docs d LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
    """


def secrets_sql() -> str:
    rules = BASE_RULES + MORE_RULES
    cuts, spans = [], []
    for order, rule in enumerate(rules):
        rx = _text(rule.regex)
        cuts.append(
            f"regexp_extract_all(body, {rx}, 0) AS m{order},"
            f" regexp_extract_all(body, {rx}, {rule.group}) AS v{order},"
            f" string_split_regex(body, {rx}) AS g{order}"
        )
        start = (
            f"coalesce(list_sum(list_transform(g{order}[1:i], lambda x: length(x))), 0)"
            f" + coalesce(list_sum(list_transform(m{order}[1:i-1], lambda x: length(x))), 0)"
        )
        spans.append(
            f"list_transform(list_filter(range(1, len(m{order}) + 1),"
            f" lambda i: length(v{order}[i]) >= {rule.least}),"
            f" lambda i: {{'s': CAST({start} AS BIGINT), 'o': {order},"
            f" 'e': CAST({start} + length(m{order}[i]) AS BIGINT), 'k': {_text(rule.kind)}}})"
        )
    base = sum(r.base for r in rules)
    text = "list_transform({}, lambda x: x.k || ':' || x.s || ':' || x.e)"
    counts = ", ".join(
        f"CAST(len(list_filter(spans, lambda x: x.o = {i})) AS BIGINT) AS n_{r.kind}"
        for i, r in enumerate(rules)
        if r.base
    )
    return f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        cut AS (SELECT doc_id, {", ".join(cuts)} FROM texts),
        found AS (SELECT doc_id, list_sort(list_concat({", ".join(spans[:2])})) AS two,
                         {", ".join(f"{s} AS s{i + 2}" for i, s in enumerate(spans[2:]))} FROM cut),
        joined AS (SELECT doc_id, list_sort(flatten([two, {", ".join(
            f"s{i + 2}" for i in range(len(spans) - 2))}])) AS spans FROM found)
        SELECT doc_id, {counts},
               sha256(array_to_string({text.format(f"list_filter(spans, lambda x: x.o < {base})")}, ','))
                   AS base_sha256,
               coalesce(array_to_string({text.format("spans")}, ','), '') AS spans
        FROM joined
    """


def urls_sql() -> str:
    fits = "\n".join(
        f"        WHEN (host = {_text(r.name.split('/')[0])}"
        f" OR ends_with(host, {_text('.' + r.name.split('/')[0])}))"
        f" AND starts_with(path, {_text(r.name[r.name.index('/'):])}) THEN {_text(r.name)}"
        for r in sorted(SITE_RULES, key=lambda r: -r.rank)
    )
    junk = " ".join(
        f"WHEN regexp_matches(host || path, {_text(r.regex)}) THEN {_text(r.name)}"
        for r in sorted(JUNK_RULES, key=lambda r: r.name, reverse=True)
    )
    verdicts = " ".join(f"WHEN {_text(r.name)} THEN {_text(r.verdict)}" for r in SITE_RULES)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                             '{upper}', '{upper.lower()}') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        named AS (
            SELECT *, CASE
{fits}
                ELSE NULL END AS rule,
                CASE {junk} ELSE NULL END AS junk
            FROM parts)
        SELECT page_id, host, path, rule,
               CASE rule {verdicts}
                   ELSE CASE WHEN junk IS NULL THEN 'allow' ELSE 'block' END END AS verdict,
               CASE WHEN rule IS NULL THEN junk END AS pattern
        FROM named
    """


def all_statements() -> dict[str, str]:
    return {
        "op2_html_text": html_sql(),
        "op5_decontaminate": decontaminate_sql(),
        "op6_secret_scan": secrets_sql(),
        "op7_url_filter": urls_sql(),
    }
