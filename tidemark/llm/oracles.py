"""DuckDB queries of the operators whose results plain SQL can state, by routes of their own."""

from __future__ import annotations

#: crc32 of a short ASCII text, bit by bit.
CRC32 = """xor(list_reduce(list_transform(string_split({0}, ''), lambda ch: cast(ord(ch) as bigint)),
      lambda c, b: list_reduce(range(8), lambda d, i: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)), cast(4294967295 as bigint)), 4294967295)"""


def _crc32(text: str) -> str:
    return CRC32.format(text)


def _levels(name: str, depth: int) -> str:
    """Levels ``name``1 and on of the trees whose leaves are ``name``0 (source, pos, n, digest)."""
    return ",\n".join(
        f"""{name}{k} as (select source, pos // 16 as pos, (n + 15) // 16 as n, list(digest order by pos) as kids,
          sha256(string_agg(digest, '' order by pos)) as digest from {name}{k - 1} where n > 1 group by source, pos // 16, n)"""
        for k in range(1, depth + 1))


def _folds(name: str, fold: str, depth: int) -> str:
    left, right = "array_to_string(p.kids[1:f.pos % 16], '')", "array_to_string(p.kids[f.pos % 16 + 2:], '')"
    return ",\n".join(
        f"""{fold}{k} as (select f.* exclude (pos, proof, folded), coalesce(p.pos, f.pos) as pos,
          case when p.pos is null then f.proof else concat(f.proof, {left}, {right}) end as proof,
          case when p.pos is null then f.folded else sha256(concat({left}, f.folded, {right})) end as folded
          from {fold}{k - 1} f left join {name}{k} p on f.source is not distinct from p.source and f.pos // 16 = p.pos)"""
        for k in range(1, depth + 1))


def merkle(depth: int = 5, top: int = 4) -> str:
    """Trees of at most 16 ** depth leaves and 16 ** top sources."""
    def field(c):
        return f"coalesce(if({c} is null, null, concat(strlen(cast({c} as varchar)), ':', {c})), '-')"

    fields = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]

    def leaf(text):
        return f"sha256(concat({', '.join([*fields, field(text)])}))"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    subroots = " union all ".join(f"select source, digest from n{k} where n = 1" for k in range(depth + 1))
    return f"""
    with d as (select doc_id, source, {leaf('text')} as digest,
        case when {_crc32("cast(doc_id as varchar)")} % 5 = 0 then {leaf(lowered)} end as altered from documents),
    n0 as (select *, row_number() over (partition by source order by doc_id nulls first, digest) - 1 as pos, count(*) over (partition by source) as n from d),
    {_levels("n", depth)},
    f0 as (select doc_id, source, digest as leaf, pos, '' as proof, coalesce(altered, digest) as folded from n0),
    {_folds("n", "f", depth)},
    s as ({subroots}),
    t0 as (select 0 as source, source as name, digest, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n from s),
    {_levels("t", top)},
    r as ({" union all ".join(f"select digest from t{k} where n = 1" for k in range(top + 1))}),
    g0 as (select f.doc_id, f.leaf, 0 as source, t0.pos, t0.digest as subroot, f.proof, f.folded
      from f{depth} f join t0 on f.source is not distinct from t0.name),
    {_folds("t", "g", top)}
    select doc_id, leaf, subroot, r.digest as root, sha256(proof) as proof_sha256, folded as folded_root, folded = r.digest as verified
    from g{top}, r"""


def prefix_trie() -> str:
    """By members: a node's subtree holds what its members hold below it, each node counted for its smallest member."""
    crc = _crc32("cast(c as varchar)")
    return f"""
    with o as (select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x,
        row_number() over (partition by conv_id order by turn nulls first, sha256(concat(strlen(coalesce(role, '')), ':', role, text))) as i
        from conversations where conv_id is not null),
    ids as (select c, {crc} % 6 as h from (select distinct c from o)),
    base as (select ids.c, h, count(o.c) as n from ids left join o on o.c = ids.c - ids.c % 100 and o.i <= h group by ids.c, h),
    rebuilt as (select base.c, o.i as d, r, x from base join o on o.c = base.c - base.c % 100 and o.i <= h
      union all select base.c, n + o.i - h, r, x from base join o on o.c = base.c and o.i > h),
    steps as (select c, d, length(x) as chars, string_agg(sha256(concat(strlen(r), ':', r, x)), '') over (partition by c order by d) as key from rebuilt
      union all select c, 0, 0, '' from ids),
    member as (select *, min(c) over (partition by key) as rep, count(*) over (partition by key) as n, max(d) over (partition by c) = d as ends from steps),
    marked as (select *, ends and c = rep and count(*) filter (ends) over (partition by key) = n as leaf,
      sum(chars) over below - sum(if(c = rep, chars, 0)) over below as saved,
      lead(c = rep) over up as child, lag(rep) over up as parent from member
      window below as (partition by c order by d desc), up as (partition by c order by d)),
    whole as (select *, bool_or(leaf) over (partition by c) as has_leaf from marked)
    select min(c) as conv_id, cast(min(d) as bigint) as depth, min(parent) as parent_conv_id, count(*) as n_convs,
      cast(count(*) filter (child) as bigint) as n_children, count(*) filter (has_leaf) as n_leaves, cast(sum(saved) as bigint) as saved_tokens,
      sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (ends), '')) as ends_sha256
    from whole group by key"""


TOP_K = """
    with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
      where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
      from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id)
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
    from s qualify rank <= 5"""
