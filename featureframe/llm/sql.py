"""DuckDB SQL for the longer oracles of the corpus operators."""

from __future__ import annotations

#: crc32 by its table of 256 remainders; ``crc32_of`` takes a list of bytes.
_CRC_TABLE = """crc as materialized (
        select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
            lambda c, step: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as remainders
    )"""


def _crc32_of(values: str) -> str:
    """crc32 of an expression that gives a list of bytes, where ``crc`` is joined."""
    step = "xor(c >> 8, remainders[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {values}), lambda c, b: {step}), 4294967295)"


_DIGITS_OF_ID = "list_transform(string_split(doc_id::varchar, ''), lambda x: unicode(x)::bigint)"


def line_dedup() -> str:
    return """
    with lines as (
        select doc_id, generate_subscripts(l, 1) as pos, unnest(l) as line
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)
    ), keyed as (
        select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
        from lines
    ), shared as (
        select key, max(doc_id) as last from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3
    ), judged as (
        select k.doc_id, pos, line, coalesce(doc_id <> last, false) as gone from keyed k left join shared s on k.key = s.key
    )
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
    from judged group by doc_id
    """


def spelling() -> str:
    """Words are near where their edit distance is 1; compared by length and by either half."""
    letters = "list_transform(string_split(run, ''), lambda x: unicode(x)::bigint)"
    octets = f"flatten(list_transform({letters}, lambda x: case when x < 128 then [x] else [195, x - 64] end))"
    return f"""
    with recursive {_CRC_TABLE}, runs as (
        select doc_id, run, count(*) as n from (
            select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run
            from documents
        ) group by doc_id, run
    ), hashed as (
        select run, n, {_crc32_of(f"list_concat({_DIGITS_OF_ID}, [58::bigint], {octets})")} as h from runs, crc
    ), words as materialized (
        select word, sum(n)::bigint as n from (
            select case when h % 199 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word, n from hashed
        ) where length(word) >= 6 group by word having sum(n) >= 5
    ), met as (
        select a.word, b.word as near, b.n from words a join words b
            on left(a.word, 3) = left(b.word, 3) and abs(length(a.word) - length(b.word)) <= 1 and a.word <> b.word
        union
        select a.word, b.word, b.n from words a join words b
            on right(a.word, 3) = right(b.word, 3) and abs(length(a.word) - length(b.word)) <= 1 and a.word <> b.word
    ), nears as (
        select word, count(*) as n_near, max(n) as most, min(struct_pack(m := -n, near := near)).near as best
        from met
        where (
            (length(word) = length(near) and len(list_filter(range(1, length(word) + 1), lambda i: word[i] <> near[i])) = 1)
            or (length(word) + 1 = length(near)
                and len(list_filter(range(1, length(near) + 1), lambda i: near[:i - 1] || near[i + 1:] = word)) > 0)
            or (length(near) + 1 = length(word)
                and len(list_filter(range(1, length(word) + 1), lambda i: word[:i - 1] || word[i + 1:] = near)) > 0)
          )
        group by word
    ), forms as materialized (
        select w.word, w.n, coalesce(n_near, 0) as n_near, case when most >= 5 * w.n then best end as form,
               case when most >= 5 * w.n then most end as form_n
        from words w left join nears on w.word = nears.word
    ), followed as (
        select word, word as root, form as next from forms
        union all
        select f.word, f.next, g.form from followed f join forms g on g.word = f.next
    )
    select f.word, f.form, r.root, f.n, f.n_near, f.form_n from forms f join followed r on r.word = f.word and r.next is null
    """


def _field(name: str) -> str:
    text = f"{name}::varchar"
    return f"case when {name} is null then '-' else strlen({text}) || ':' || {text} end"


def _levels(name: str, levels: int) -> list[str]:
    """Steps over ``name_0`` (``tree, place, digest, n``): each level, and its digests by runs."""
    steps = []
    for level in range(levels):
        steps += [
            f"""{name}_runs_{level} as materialized (
        select tree, place // 3 as run, n, list(digest order by place) as digests from {name}_{level} group by tree, place // 3, n)""",
            f"""{name}_{level + 1} as materialized (
        select tree, run as place, case when n = 1 then digests[1] else sha256(array_to_string(digests, '')) end as digest,
               (n + 2) // 3 as n from {name}_runs_{level})""",
        ]
    return steps


def _folds(name: str, start: str, levels: int) -> list[str]:
    """Steps over ``start`` (``tree, place, proof, fold``, others): up through the levels, with the siblings passed."""
    steps = []
    for level in range(levels):
        before = start if level == 0 else f"{name}_fold_{level}"
        steps.append(
            f"""{name}_fold_{level + 1} as materialized (
        select f.* replace (place // 3 as place,
                   case when n = 1 then proof else proof || array_to_string(digests[:place % 3], '') || array_to_string(digests[place % 3 + 2:], '') end as proof,
                   case when n = 1 then fold else sha256(array_to_string(digests[:place % 3], '') || fold || array_to_string(digests[place % 3 + 2:], '')) end as fold)
        from {before} f join {name}_runs_{level} r on r.tree is not distinct from f.tree and r.run = f.place // 3)"""
        )
    return steps


def merkle(levels: int = 12, top_levels: int = 6) -> str:
    """For place most ``3 ** levels`` rows of a source and ``3 ** top_levels`` sources."""
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    leaf = f"sha256({' || '.join(map(_field, fields))})"
    forged = "case when crc % 2 = 0 then replace(text, chr(10), '') else text end"
    forged_leaf = f"sha256({' || '.join(map(_field, fields[:-1]))} || {_field('forged')})"
    steps = [
        _CRC_TABLE,
        f"""rows as (
        select *, {forged} as forged from (select d.*, {_crc32_of(_DIGITS_OF_ID)} as crc from documents d, crc))""",
        f"""leaves as materialized (
        select doc_id, source as tree, leaf, fold,
               row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place,
               count(*) over (partition by source) as n
        from (select doc_id, source, {leaf} as leaf, {forged_leaf} as fold from rows))""",
        "source_0 as (select tree, place, leaf as digest, n from leaves)",
        *_levels("source", levels),
        f"""top_0 as materialized (
        select 0 as tree, tree as source, digest, row_number() over (order by tree nulls first) - 1 as place, count(*) over () as n
        from source_{levels})""",
        *_levels("top", top_levels),
        "start as (select doc_id, tree, leaf, place, '' as proof, fold from leaves)",
        *_folds("source", "start", levels),
        f"""middle as (
        select f.doc_id, f.leaf, t.digest as subroot, 0 as tree, t.place, f.proof, f.fold
        from source_fold_{levels} f join top_0 t on t.source is not distinct from f.tree)""",
        *_folds("top", "middle", top_levels),
    ]
    return f"""
    with {', '.join(steps)}
    select doc_id, leaf, subroot, digest as root, sha256(proof) as proof_sha256, fold as folded_root, fold = digest as verified
    from top_fold_{top_levels}, top_{top_levels}
    """
