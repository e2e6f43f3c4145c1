"""DuckDB SQL of the manifest and the vector codes, written out level by level."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str = "text") -> str:
    def field(value: str) -> str:
        value = f"cast({value} as varchar)"
        return f"coalesce(cast(strlen({value}) as varchar) || ':' || {value}, '-')"

    fields = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({fields})"


def _levels(name: str, tree: str, levels: int) -> str:
    """From ``name``0 (tree, r, digest): per level the nodes above, and each node's siblings."""
    same = f"partition by {tree}, r // 8 order by r"
    steps = []
    for k in range(levels):
        steps.append(
            f"{name}_sib{k} as (select {tree}, r,"
            f" count(*) over (partition by {tree}) > 1 as more,"
            f" coalesce(string_agg(digest, '') over ({same} rows between unbounded preceding"
            " and 1 preceding), '') as before,"
            f" coalesce(string_agg(digest, '') over ({same} rows between 1 following"
            f" and unbounded following), '') as after from {name}{k})"
        )
        steps.append(
            f"{name}{k + 1} as (select {tree}, r // 8 as r,"
            " case when any_value(n) > 1 then sha256(string_agg(digest, '' order by r))"
            f" else any_value(digest) end as digest from (select *, count(*) over"
            f" (partition by {tree}) as n from {name}{k}) group by {tree}, r // 8)"
        )
    return ", ".join(steps)


def manifest(levels: int = 8, lang_levels: int = 3) -> str:
    """For up to 8 ** ``levels`` documents of a language and 8 ** ``lang_levels`` languages."""
    steps = [
        f"leaves as (select doc_id, lang, {_leaf()} as leaf, {_leaf(_LOWER)} as lowered"
        " from documents)",
        "placed as (select *, row_number() over (partition by lang order by doc_id, leaf) - 1"
        " as place from leaves)",
        "doc0 as (select lang, place as r, leaf as digest from placed)",
        _levels("doc", "lang", levels),
        f"subroots as (select lang, digest as subroot from doc{levels})",
        "lang0 as (select 0 as one, row_number() over (order by lang nulls first) - 1 as r,"
        " subroot as digest from subroots)",
        _levels("lang", "one", lang_levels),
        "langs as (select lang, subroot, row_number() over (order by lang nulls first) - 1 as at"
        " from subroots)",
        "start as (select p.doc_id, p.lang, p.place, l.at, p.leaf, l.subroot,"
        f" (select digest from lang{lang_levels}) as root, '' as seen,"
        " case when crc32_of_id % 3 = 0 then p.lowered else p.leaf end as f"
        f" from (select *, {crc32('cast(doc_id as varchar)')} as crc32_of_id from placed) p"
        " join langs l on p.lang is not distinct from l.lang)",
    ]
    name = "start"
    for k in range(levels + lang_levels):
        low = k < levels
        on = (
            f"x.lang is not distinct from b.lang and b.r = x.place // {8**k}"
            if low
            else f"b.r = x.at // {8 ** (k - levels)}"
        )
        side = f"doc_sib{k}" if low else f"lang_sib{k - levels}"
        steps.append(
            f"fold{k} as (select x.* replace (case when b.more then"
            " sha256(b.before || x.f || b.after) else x.f end as f,"
            " x.seen || b.before || b.after as seen)"
            f" from {name} x join {side} b on {on})"
        )
        name = f"fold{k}"
    return (
        f"with {', '.join(steps)} select doc_id, leaf, subroot, root,"
        " sha256(seen) as proof_sha256, f as folded_root, f = root as verified"
        f" from {name}"
    )


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bit = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    byte = (
        "list_reduce(list_prepend(xor(crc, ch), cast(range(8) as bigint[])),"
        f" lambda c, i: {bit})"
    )
    chars = f"list_transform(string_split({text}, ''), lambda ch: cast(ascii(ch) as bigint))"
    all_ones = "cast(4294967295 as bigint)"
    return f"xor(list_reduce(list_prepend({all_ones}, {chars}), lambda crc, ch: {byte}), {all_ones})"


def vector_codes(rounds: int = 4) -> str:
    """Every part against every entry, in each round."""
    steps = [
        "kept as (select vec_id, label, embedding from embeddings where embedding is not null"
        " and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        "numbered as (select *, row_number() over (order by vec_id) - 1 as row from kept)",
        "numbers as (select row, vec_id, label, unnest(embedding) as x,"
        " generate_subscripts(embedding, 1) - 1 as dim, len(embedding) // 4 as w from numbered)",
        "points as materialized (select row, dim // w as part, dim % w as pos,"
        " cast(floor(1024 * cast(x as double)) as bigint) as x from numbers)",
        "book0 as materialized (select part, row as entry, pos, x as c from points"
        " where row < 256)",
    ]
    for k in range(rounds + 1):
        steps.append(
            f"near{k} as materialized (select row, part, min(struct_pack(d := d, entry := entry))"
            " as best from (select row, p.part, entry, sum((x - c) * (x - c)) as d from points p"
            f" join book{k} b on p.part = b.part and p.pos = b.pos group by all) group by all)"
        )
        if k < rounds:
            steps.append(
                f"mean{k} as (select part, best.entry as entry, pos, sum(x) as s, count(*) as n"
                f" from near{k} join points using (row, part) group by all)"
            )
            steps.append(
                f"book{k + 1} as materialized (select part, entry, pos,"
                " cast(coalesce((s - ((s % n) + n) % n) // n, c) as bigint) as c"
                f" from book{k} left join mean{k} using (part, entry, pos))"
            )
    steps.append(
        "coded as (select row, string_agg(printf('%02x', cast(best.entry as int)), '' order by part)"
        f" as code, cast(sum(best.d) as bigint) as error from near{rounds} group by row)"
    )
    return (
        f"with {', '.join(steps)} select vec_id, code, error,"
        " cast(sum(error) over (partition by label) as bigint) as label_error,"
        " (select sha256(string_agg(cast(c as varchar), ',' order by part, entry, pos))"
        f" from book{rounds}) as codebooks_sha256 from coded join numbered using (row)"
    )
