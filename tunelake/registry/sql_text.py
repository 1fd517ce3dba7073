"""DuckDB text for the checks: white space, stripping, SQL normal form."""

from __future__ import annotations

WS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def strip(e: str) -> str:
    return f"regexp_replace({e}, '\\A{WS}+|{WS}+\\z', '', 'g')"


def normalized_cte(name: str, source: str, columns: str, text: str) -> str:
    """CTE ``name``: ``columns`` of ``source`` plus ``norm``, the normal form of ``text``."""
    def find(t: str) -> str:
        return f"nullif(greatest(instr(tail, {t}) - 1, 0), 0)"

    terminators = (
        "';'", "repeat('`',3)", "concat(chr(10),'`')", "concat(chr(10),chr(10),'Note')",
        "concat(chr(10),chr(10),'This ')", "concat(chr(10),chr(10),'Explanation')",
    )
    tags = ("<end_of_turn>", "<start_of_turn>", "<|im_end|>", "<|im_start|>", "model", "user")
    cut = "body"
    for tag in tags:
        cut = f"split_part({cut}, '{tag}', 1)"
    bare = strip("regexp_replace(" + strip("CASE WHEN cut_at IS NULL THEN tail ELSE left(tail, cut_at) END") + ", '\\A`+', '')")
    tidy = strip(f"regexp_replace(regexp_replace({strip(cut)}, ';+\\z', ''), '`+\\z', '')")
    lowered = f"lower(replace({tidy}, chr(39), chr(34)))"
    squeezed = strip(f"regexp_replace({lowered}, '{WS}+', ' ', 'g')")
    return f"""
{name}_a AS (SELECT {columns}, {strip(f"coalesce({text}, '')")} AS s FROM {source}),
{name}_b AS (SELECT *,
  CASE WHEN regexp_matches(s, '(?is)```(?:sql)?\\s*\\n?(.*?)```') THEN regexp_extract(s, '(?is)```(?:sql)?\\s*\\n?(.*?)```', 1) END AS fenced,
  CASE WHEN regexp_matches(s, '(?i)\\bSELECT\\b') THEN regexp_extract(s, '(?is)\\A.*(\\bSELECT\\b.*)\\z', 1) END AS tail FROM {name}_a),
{name}_c AS (SELECT *, least({', '.join(find(t) for t in terminators)}) AS cut_at FROM {name}_b),
{name}_d AS (SELECT *, coalesce({strip('fenced')}, {bare}, s) AS body FROM {name}_c),
{name} AS (SELECT {columns}, {squeezed} AS norm FROM {name}_d)"""
