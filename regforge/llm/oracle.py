"""DuckDB SQL for the queries that SQL can express."""

BLANKS = r"[\x20\x09-\x0D]"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def repair_sql() -> str:
    """The repair as a recursion over turns that keeps the least (cost, audit, text) per state."""
    key = "coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')"
    bits = f"flatten(list_transform(string_split({key}, ''), lambda c: list_transform(range(8), lambda i: (ascii(c) >> i) & 1)))"
    # The checksum bit by bit.
    crc = (
        f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform({bits}, lambda b: cast(b as bigint))), "
        "lambda c, b: xor(c >> 1, 3988292384 * xor(c & 1, b))), 4294967295)"
    )
    line = "q.t || case when q.t = '' then '' else chr(10) end || "

    def step(q: str, cost: str, code: str, text: str = "") -> str:
        made = f"{{'c': {q}.c + {cost}, 'a': {q}.a || '{code}', 't': {(line + text).replace('q.t', q + '.t') if text else q + '.t'}}}"
        return f"case when {q} is not null then {made} end"

    def kept(q: str, initial: str) -> str:
        return f"case when not bad and left(role, 1) = '{initial}' then {step(q, 'cut', 'K', chr(39) * 2 + ' || role || ' + repr(':') + ' || text')} end"

    def given(q: str, role: str) -> str:
        return f"case when not bad then {step(q, '3 + cut', 'R', repr(role + ':') + ' || text')} end"

    def added(q: str, role: str) -> str:
        return step(q, "3", "I", repr(role + ":"))

    def least(*choices: str) -> str:
        return f"list_min([{', '.join(choices)}])"

    def with_insertions(source: str) -> str:
        users = least("u", *(added(q, "user") for q in ("n", "s", "a")))
        return f"""select conv_id, i, n, s, u, {least("a", added("u", "assistant"))} a
  from (select conv_id, i, n, s, a, {users} u from ({source}))"""

    state = "struct(c bigint, a varchar, t varchar)"
    return rf"""
with recursive hurt as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) copy
  from (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc} % 20 as kind from conversations)
),
placed as (
  select *, row_number() over w i, lag(left(role, 1)) over w || left(role, 1) pair, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) body
  from hurt
  window w as (partition by conv_id order by turn nulls first, sha256(length(role) || ':' || role || text))
),
turns as (
  select *, body = '' or again bad, case when body <> '' and not again and right(body, 1) not in ('.', '!', '?') then 3 else 0 end cut
  from (select *, row_number() over (partition by conv_id, role, text order by i) > 1 again from placed)
),
counts as (
  select conv_id, max(i) last, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (where body = '') blank,
         count(*) filter (where body <> '' and again) duplicate, count(*) filter (where cut > 0) truncated,
         count(*) filter (where pair not in ('su', 'ua', 'au')) illegal
  from turns group by conv_id
),
dp as (
  {with_insertions(f"select distinct conv_id, cast(0 as bigint) i, cast({{'c': 0, 'a': '', 't': ''}} as {state}) n, cast(null as {state}) s, cast(null as {state}) u, cast(null as {state}) a from conversations")}
  union all
  {with_insertions(f"""select conv_id, turns.i, {step("n", "4", "D")} n,
      {least(step("s", "4", "D"), kept("n", "s"))} s,
      {least(step("u", "4", "D"), *(kept(q, "u") for q in ("n", "s", "a")), *(given(q, "user") for q in ("n", "s", "a")))} u,
      {least(step("a", "4", "D"), kept("u", "a"), given("u", "assistant"))} a
    from dp join turns using (conv_id) where turns.i = dp.i + 1""")}
),
solved as (select conv_id, {least("n", "a")} best from dp left join counts using (conv_id) where dp.i = coalesce(last, 0))
select conv_id, cast(coalesce(gaps, 0) as bigint) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated,
       coalesce(illegal, 0) illegal, best.c as cost, best.a as audit, sha256(best.t) repaired_sha256
from solved left join counts using (conv_id)
"""


ORACLE_SQL: dict[str, str] = {
    "op5_minhash_near_dedup": rf"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BLANKS}+'), lambda x: x <> '') w
  from documents
),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) s
  from words
),
sizes as (select doc_id, count(s) n from words left join shingles using (doc_id) group by doc_id),
common as (
  select a.doc_id a, b.doc_id b, count(*) c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all
),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)
),
reach(doc_id, root) as (
  select doc_id, doc_id from sizes
  union
  select b, root from reach join links on a = doc_id
)
select doc_id, n n_shingles, component_id, doc_id = component_id kept
from sizes join (select doc_id, min(root) component_id from reach group by doc_id) using (doc_id)
""",
    "op6_exact_dedup": rf"""
with d as (
  select doc_id, length(coalesce(text, '')) n,
         sha256(regexp_replace(coalesce(text, ''), '{BLANKS}', '', 'g')) h
  from documents
)
select doc_id,
       first_value(doc_id) over (partition by h order by n desc, doc_id) keep_id,
       count(*) over (partition by h) group_size,
       doc_id = first_value(doc_id) over (partition by h order by n desc, doc_id) kept,
       h text_sha256
from d
""",
    "op13_hard_negatives": """
with rows_ as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) v,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end label
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
scores as (
  select a.vec_id anchor_id, a.label, b.vec_id other, b.label other_label,
         cast(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) as bigint) score
  from rows_ a join rows_ b on a.vec_id <> b.vec_id
  where a.vec_id % 100 = 0
),
positives as (
  select anchor_id, other positive_id, score positive_score from scores where other_label = label
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
)
select p.anchor_id, positive_id, cast(row_number() over w as integer) rank, other negative_id, positive_score, score negative_score
from positives p join scores s on s.anchor_id = p.anchor_id and other_label <> label
where 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by p.anchor_id, positive_id order by score desc, other)
qualify rank <= 10
""",
    "op12_conversation_repair": repair_sql(),
}
