"""Oracle SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

from turnmill.llm.hamming import K
from turnmill.llm.rules import RULES, STOP_WORDS, WINDOW
from turnmill.llm.warc import REVISIT_FROM_BYTES

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))


def _rule(rule) -> str:
    value = f"{rule.numerator}::double"
    if rule.denominator:
        value = f"(case when {rule.denominator} = 0 then 0 else {rule.numerator} / {rule.denominator}::double end)"
    held = [f"{value} >= {rule.low}"] * (rule.low is not None) + [f"{value} <= {rule.high}"] * (rule.high is not None)
    return f"(({' and '.join(held)}) or n_words < {rule.from_words})"


def _all_orders(letters: str = "ABCDE") -> str:
    names = [f"l{i}" for i in range(1, len(letters) + 1)]
    differ = " and ".join(f"{a} <> {b}" for i, a in enumerate(names) for b in names[i + 1 :])
    values = ", ".join(f"('{x}')" for x in letters)
    tables = ", ".join(f"(values {values}) as t{n}({n})" for n in names)
    return f"select {' || '.join(names)} as filter_order from {tables} where {differ}"


ORACLE = {
    "op2_warc_transactions": f"""
        with p as (select page_id, coalesce(html, '') as body from pages),
        d as (select page_id, strlen(body) as payload_bytes, sha256(body) as payload_digest from p),
        f as (select *, min(page_id) over (partition by payload_digest) as first from d)
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= {REVISIT_FROM_BYTES} and first <> page_id then 'revisit'
                    else 'response' end as record_type,
               case when payload_bytes >= {REVISIT_FROM_BYTES} and first <> page_id then first end as refers_to
        from f""",
    "op6_multi_index_hashing": f"""
        with b as (select vec_id, list_transform(embedding, lambda x: x > 0) as bits from embeddings),
        q as (select * from b where vec_id % 20 = 0),
        d as (select q.vec_id as query_id, b.vec_id as neighbor_id,
                     len(list_filter(list_zip(q.bits, b.bits), lambda p: p[1] <> p[2])) as distance from q, b),
        r as (select *, row_number() over (partition by query_id order by distance, neighbor_id) as rank from d)
        select query_id, rank, neighbor_id, distance from r where rank <= {K}""",
    "op7_quality_rules": f"""
        with t as (select doc_id, coalesce(text, '') as text from documents),
        w as (select *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words,
                     list_filter(string_split(text, chr(10)), lambda x: trim(x, {_BLANKS}) <> '') as lines from t),
        g as (select doc_id, unnest(range(1, len(words) - {WINDOW} + 2)) as i, words from w where len(words) >= {WINDOW}),
        h as (select doc_id, i, list_slice(words, i, i + {WINDOW} - 1) as gram from g),
        r as (select doc_id, i from h qualify count(*) over (partition by doc_id, gram) > 1),
        c as (select doc_id, least({WINDOW}, coalesce(lead(i) over (partition by doc_id order by i) - i, {WINDOW})) as k
              from r),
        n as (select doc_id, sum(k)::bigint as n_repeat_words from c group by doc_id),
        m as (select doc_id, len(words) as n_words, strlen_points as word_chars, n_symbols, n_exclamations, n_capitals,
                     len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
                     coalesce(n_repeat_words, 0) as n_repeat_words,
                     len(list_filter(list_distinct(words), lambda x: x in ({_STOP}))) as n_stop_words
              from (select *, length(array_to_string(words, '')) as strlen_points,
                           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
                           length(regexp_replace(text, '[^!]+', '', 'g')) as n_exclamations,
                           length(regexp_replace(text, '[^\\p{{Lu}}]+', '', 'g')) as n_capitals from w)
              left join n using (doc_id)),
        b as (select *, n_words < 10 or n_repeat_words * 100 > n_words * 20 as base_failed from m)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               not base_failed and {' and '.join(map(_rule, RULES))} as kept
        from b""",
    "op13_filter_audit": f"""
        with t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents),
        w as (select *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words
              from t),
        l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by 1),
        f as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
                     case when len(words) < 50 then 'A' else '' end
                     || case when 100 * len(list_distinct(words)) < 65 * len(words) then 'B' else '' end
                     || case when 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 5 * length(text)
                             then 'C' else '' end
                     || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
                     || case when doc_id > min(doc_id) over (partition by text) then 'E' else '' end as fails
              from w left join l using (doc_id)),
        c as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by all),
        o as ({_all_orders()}),
        s as (select filter_order, step, substr(filter_order, step, 1) as own, substr(filter_order, 1, step - 1) as before
              from o, unnest(range(1, 6)) as u(step)),
        e as (select *, contains(fails, own) as fail,
                     len(list_intersect(string_split(fails, ''), string_split(before, ''))) > 0
                     and fails <> '' and before <> '' as gone
              from c, s)
        select part, filter_order, step::int as step,
               coalesce(sum(n) filter (not gone and not fail), 0)::bigint as kept,
               coalesce(sum(n) filter (fail and not gone), 0)::bigint as removed,
               coalesce(sum(n) filter (fail and gone), 0)::bigint as redundant,
               coalesce(sum(n) filter (fails = own), 0)::bigint as unique_fails,
               coalesce(sum(good) filter (fail and not gone), 0)::bigint as good_lost,
               coalesce(sum(toxic) filter (fail and not gone), 0)::bigint as toxic_lost,
               coalesce(sum(n * 120 // greatest(length(fails), 1)) filter (fail), 0)::bigint as shapley
        from e group by part, filter_order, step""",
}
