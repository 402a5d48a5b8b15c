"""DuckDB SQL for the mix of the ``documents`` table, with global windows."""

from __future__ import annotations

from collections.abc import Mapping


def _case(name: str, weights: Mapping[str, int]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items())
    return f"CASE {name} {cases} ELSE 1 END" if weights else "1"


def _share(table: str, parent: str, name: str, weight: str) -> str:
    family = f"PARTITION BY {parent}" if parent else ""
    order = f"{family} ORDER BY cap / w, {name} NULLS FIRST"
    return f"""
        SELECT * EXCLUDE (w, x, lft, wts, fam), CAST(CASE WHEN fam <= budget THEN cap
            ELSE greatest(0, least(cap, (w * first(lft) OVER t) // (first(wts) OVER t))) END AS BIGINT) AS give
        FROM (SELECT *, lft / wts AS x FROM (SELECT *,
            budget - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
            sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wts,
            sum(cap) OVER ({family}) AS fam
            FROM (SELECT *, {weight} AS w FROM {table})))
        WINDOW t AS ({family} ORDER BY x DESC, lft DESC, wts DESC
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""


def mix_sql(
    domain: str, domains: Mapping[str, int], langs: Mapping[str, int], sources: Mapping[str, int],
    percent: int, epochs: int, seed: int,
) -> str:
    return f"""
    WITH docs AS (
        SELECT doc_id, {domain} AS domain, lang, source, strlen(text) AS n_tokens FROM documents
    ), leaves AS (
        SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply, {epochs} * sum(n_tokens)::BIGINT AS cap
        FROM docs GROUP BY ALL
    ), d AS (
        SELECT domain, sum(cap)::BIGINT AS cap,
               (SELECT sum(supply) FROM leaves)::BIGINT * {percent} // 100 AS budget
        FROM leaves GROUP BY domain
    ), ds AS ({_share('d', '', 'domain', _case('domain', domains))}
    ), l AS (
        SELECT x.*, ds.give AS budget FROM
        (SELECT domain, lang, sum(cap)::BIGINT AS cap FROM leaves GROUP BY ALL) x JOIN ds USING (domain)
    ), ls AS ({_share('l', 'domain', 'lang', _case('lang', langs))}
    ), s AS (
        SELECT leaves.*, ls.give AS budget FROM leaves JOIN ls USING (domain, lang)
    ), ss AS ({_share('s', 'domain, lang', 'source', _case('source', sources))}
    ), whole AS (
        SELECT d.*, give // supply AS whole, give % supply AS rest
        FROM docs d JOIN ss USING (domain, lang, source) WHERE give > 0
    ), placed AS (
        SELECT *, CAST('0x' || substr(md5('{seed}|' || whole || '|' || doc_id), 1, 13) AS BIGINT) AS u FROM whole
    ), ordered AS (
        SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY u, doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n_tokens AS start FROM placed
    )
    SELECT doc_id, domain, lang, source, e::INTEGER AS epoch, n_tokens::BIGINT AS n_tokens, n_tokens::BIGINT AS taken
    FROM whole, unnest(range(whole::BIGINT)) r(e) WHERE n_tokens > 0
    UNION ALL
    SELECT doc_id, domain, lang, source, whole::INTEGER, n_tokens::BIGINT, least(n_tokens, rest - start)::BIGINT
    FROM ordered WHERE least(n_tokens, rest - start) > 0"""
