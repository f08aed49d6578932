"""SQL for the queries of this subpackage that SQL can express, over the same tables."""

from __future__ import annotations

from chainloom.llm import mixing, pii

BLANK = r"[\x20\x09-\x0D]"

CHAT = r"""
    with t as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -7, u.turn, u.role, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) u(turn, role)
    ), a as (
        select *, replace(text, '<', '<\') as body, position(chr(10) in text) as line, length(text) as n, role <> 'assistant' as attaches,
            ['image', 'audio', 'document'][coalesce(turn, 0) % 3 + 1] as kind, 'turn ' || coalesce(turn::varchar, '') as ref
        from t
    ), b as (
        select *, case kind when 'image' then greatest(1, ceil(n / 448.0)) * 64 when 'audio' then greatest(1, ceil(n / 10.0)) * 25 else greatest(1, ceil(n / 1000.0)) * 512 end::bigint as tokens,
            length('<turn ' || url_encode(role) || '>' || chr(10)) as head,
            length(replace(case when line > 0 then text[:line - 1] else text end, '<', '<\')) as before
        from a
    ), e as (
        select *, case when attaches then '<attach ' || kind || ' ' || replace(ref, ' ', '+') || ' ' || tokens || '>' else '' end as mark from b
    ), f as (
        select *, head + length(body) + length(mark) + length('</turn>' || chr(10)) as frag from e
    ), g as (
        select *, coalesce(sum(frag) over (partition by conv_id order by turn nulls first, role, body rows between unbounded preceding and 1 preceding), 0) as base from f
    )
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, body)) as turns_sha256,
        coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn nulls first, role, body) filter (role = 'assistant'), '')) as loss_sha256,
        sum(frag)::bigint as formatted_chars,
        count(*) filter (attaches) as n_attachments,
        coalesce(sum(tokens) filter (attaches), 0)::bigint as n_attach_tokens,
        coalesce(string_agg(kind || ':' || ref || ':' || tokens, ',' order by turn nulls first, role, body) filter (attaches), '') as attachments,
        coalesce(sum(base + head + before) filter (attaches), 0)::bigint as attachment_places
    from g group by conv_id
"""

TOP_K = """
    with v as (
        select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), s as (
        select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
        from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)
    ), r as (
        select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from s
    )
    select query_id, rank::int as rank, vec_id, score from r where rank <= 20
"""

NEGATIVES = """
    with e as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
        where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), s as (
        select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_inner_product(a.v, c.v)::bigint as score
        from e a join e c on a.vec_id % 100 = 0 and len(a.v) = len(c.v) and a.vec_id <> c.vec_id
    ), p as (
        select anchor_id, vec_id as positive_id, score as positive_score from s where same
        qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
    )
    select p.anchor_id, positive_id, row_number() over w as rank, s.vec_id as negative_id, positive_score, s.score as negative_score
    from p join s on p.anchor_id = s.anchor_id and not s.same and 80 * positive_score <= 100 * s.score and s.score <= positive_score
    window w as (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)
    qualify row_number() over w <= 5
"""

DEDUP = rf"""
    with n as (select doc_id, length(coalesce(text, '')) as n_text, regexp_replace(coalesce(text, ''), '{BLANK}', '', 'g') as norm from documents)
    select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size,
        doc_id = first_value(doc_id) over w as kept, sha256(norm) as text_sha256
    from n window w as (partition by norm order by n_text desc, doc_id)
"""


def _matches(kinds: list[tuple[str, str, int]]) -> str:
    """(doc_id, t) in d to (doc_id, kind, ord, s, e, x, g): the matches of each kind's pattern and of its group."""
    each = " union all ".join(f"select doc_id, '{k}' as kind, {o} as ord, regexp_extract_all(t, $${p}$$, 0) as m, regexp_extract_all(t, $${p}$$, {g}) as g, regexp_split_to_array(t, $${p}$$) as gaps from d" for o, (k, p, g) in enumerate(kinds))
    return f"""
        k as ({each}),
        i as (select *, unnest(range(1, len(m) + 1)) as i from k),
        f as (
            select doc_id, kind, ord, m[i] as x, g[i] as g, length(m[i]) as n, lower(right(gaps[i], 40) || ' ' || left(gaps[i + 1], 40)) as around,
                (list_sum(list_transform(gaps[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0))::bigint as s
            from i
        )"""


def _digest(base: str, order: str, counts: list[str], more: str = "") -> str:
    shown = f"string_agg(kind || ':' || s || ':' || (s + n), ',' order by {order})"
    columns = ", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in counts)
    return f"""
        select d.doc_id, {columns}, sha256(coalesce({shown} filter ({base}), '')) as base_sha256, coalesce({shown}, '') as spans{more}
        from d left join ok using (doc_id) group by d.doc_id"""


_SECRETS = [
    ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2),
    ("access", r"AKIA[A-Z0-9]+", 0),
    ("hex", r"[0-9a-f]+", 0),
    ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0),
    ("ghtoken", r"gh[pousr]_[A-Za-z0-9]{36}", 0),
]
SECRETS = f"""
    with d as (select doc_id, coalesce(text, '') as t from documents), {_matches(_SECRETS)},
    ok as (select * from f where case kind when 'assign' then length(g) >= 6 when 'access' then n >= 20 when 'hex' then n >= 24 else true end)
    {_digest("kind in ('assign', 'access', 'hex')", "s, ord", ["assign", "access", "hex"])}
"""

_PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0),
    ("card", r"[0-9]([\x20-]?[0-9])+", 0),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0),
    ("iban", pii.IBAN, 0),
]
_NEAR = " ".join(f"when '{k}' then regexp_matches(around, '{w}')" for k, w in pii.CONTEXT_WORDS.items())
_SCORE = " ".join(f"when '{d.kind}' then {round(d.score * 100)}" for d in pii.DETECTORS)
_SCORES = f", coalesce(string_agg((case kind {_SCORE} end + case when case kind {_NEAR} end then 20 else 0 end)::varchar, ',' order by ord, s), '') as scores"
_LUHN = "list_sum(list_transform(string_split(reverse(c), ''), lambda y, j: case when j % 2 = 1 then y::int when y::int > 4 then 2 * y::int - 9 else 2 * y::int end)) % 10 = 0"
_MOD97 = "list_reduce(list_transform(string_split(array_to_string(list_transform(string_split(x[5:] || x[:4], ''), lambda y: case when y >= 'A' then (ascii(y) - 55)::varchar else y end), ''), ''), lambda y: y::bigint), lambda a, y: (a * 10 + y) % 97) = 1"
PII = f"""
    with d as (select doc_id, coalesce(text, '') as t from documents), {_matches(_PII)},
    c as (select * replace (replace(x, ' ', '') as x), regexp_replace(x, '[^0-9]', '', 'g') as c from f),
    ok as (select * from c where case kind
        when 'ip' then len(list_filter(string_split(x, '.'), lambda y: length(ltrim(y, '0')) > 3 or coalesce(try_cast(nullif(ltrim(y, '0'), '') as int), 0) > 255)) = 0
        when 'card' then case when length(c) between 13 and 19 then {_LUHN} else false end
        when 'phone' then length(c) between 9 and 15
        when 'iban' then {_MOD97}
        else true end)
    {_digest("kind in ('email', 'ip', 'card', 'phone')", "ord, s", ["email", "ip", "card", "phone"], _SCORES)}
"""


def _raked(rounds: int = mixing.ROUNDS, scales: int = 16) -> str:
    out, last = "", "c0"
    for r in range(rounds):
        for k in ("source", "lang", "topic"):
            out += f"r{r}{k} as (select * replace (case when sum(weight) over (partition by {k}) > 0 then weight * {k}_share / sum(weight) over (partition by {k}) else 0 end as weight) from {last}),\n"
            last = f"r{r}{k}"
    out += f"s0 as (select 0.0::double as s),\n"
    for k in range(scales):
        full = f"tokens = 0 or weight * s{k}.s >= tokens"
        out += f"s{k + 1} as (select greatest(any_value(s{k}.s), coalesce((0.8 * sum(tokens) - sum(case when {full} then tokens else 0 end)) / nullif(sum(case when {full} then 0 else weight end), 0), 0)) as s from {last}, s{k}),\n"
    miss = ", ".join(f"abs(sum(weight) over (partition by {k}) - {k}_share)" for k in ("source", "lang", "topic"))
    return out + f"fitted as (select {last}.* exclude (weight), round(greatest({miss}), 5) as margin_miss, case when tokens > 0 then weight * s{scales}.s / tokens else 1 end as ratio from {last}, s{scales})"


MIXING = rf"""
    with d as (
        select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang,
            case when contains(text, ' | ') then 'table' when contains(text, '@') then 'contact' when contains(lower(text), 'license') then 'licence' else 'prose' end as topic,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as n_tokens
        from documents
    ), cells as (select source, lang, topic, sum(n_tokens)::bigint as tokens from d group by all),
    ts as (select source, pow(sum(tokens)::double, 0.7) as t from cells group by 1), tl as (select lang, pow(sum(tokens)::double, 0.7) as t from cells group by 1), tt as (select topic, pow(sum(tokens)::double, 0.7) as t from cells group by 1),
    c0 as (
        select cells.*, tokens::double as weight, ts.t / (select sum(t) from ts) as source_share, tl.t / (select sum(t) from tl) as lang_share, tt.t / (select sum(t) from tt) as topic_share
        from cells join ts using (source) join tl using (lang) join tt using (topic)
    ), {_raked()},
    p as (select source, lang, topic, round(least(ratio, 1), 9) as probability, round(greatest(ratio, 1), 6) as weight, margin_miss from fitted)
    select doc_id, source, lang, topic, n_tokens, probability, weight, margin_miss, ('0x' || substr(sha256(doc_id || ':0'), 1, 13))::bigint / 4503599627370496.0::double < probability as kept
    from d join p using (source, lang, topic)
"""

ORACLE_SQL: dict[str, str] = {"op1_chat_format": CHAT, "op3_topk": TOP_K, "op6_secrets": SECRETS, "op7_exact_dedup": DEDUP, "op9_mixing": MIXING, "op10_pii": PII, "op13_hard_negatives": NEGATIVES}
