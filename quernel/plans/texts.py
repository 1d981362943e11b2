"""Queries over texts, retrieval, events and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel.functions import text as T
from quernel.functions import vocabulary
from quernel.operators import incremental, lookups, providers, render, retrieval, trees, windows
from quernel.plans.registry import Registry
from quernel.session import checkpoint_dir, table
from quernel.sources import readers, sinks
from quernel.streaming import jobs

R = Registry()
QUERIES, SQL = R.queries, R.sql

DOCS = "(select doc_id, text from documents)"
#: White space of Unicode, as a class of DuckDB's expressions.
WS = "[\\s\\x{0b}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
NORMAL = f"regexp_replace(regexp_replace(text, '{WS}+', ' ', 'g'), '^ | $', '', 'g')"


def docs(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text")


TURNS = "(select distinct repo_name, log_id, agent, content from agent_log)"


def turns(spark, folder):
    return table(spark, folder, "agent_log").select("repo_name", "log_id", "agent", "content").distinct()


@R.add("normalize_ws", f"select doc_id, {NORMAL} as clean from documents")
def normalize_ws(spark, folder):
    """STR02."""
    return docs(spark, folder).select("doc_id", T.normalize_ws("text").alias("clean"))


@R.add("think_strip", f"select item_id, repo_name, location, regexp_replace(coalesce(business_summary, ''), '^{WS}+', '') as answer from (select distinct * from stage_b_function_items)")
def think_strip(spark, folder):
    """Replies whose thinking is the item's terms and signature and whose answer is its summary (STR01)."""
    rows = table(spark, folder, "stage_b_function_items").distinct()
    thought = F.concat_ws("\n", "signature", "kind", F.array_join("key_terms", "\n"))
    reply = F.concat(F.lit(" <think>"), thought, F.lit("</think>\n "), F.coalesce("business_summary", F.lit("")), F.lit("<THINK>"), thought, F.lit("</THINK>"))
    return rows.select("item_id", "repo_name", "location", T.strip_think(reply).alias("answer"))


@R.add("token_estimate", f"select doc_id, round(case when coalesce({NORMAL}, '') = '' then 0 else len(string_split({NORMAL}, ' ')) end * 1.3::double, 6) as tokens from documents")
def token_estimate(spark, folder):
    """TOK01."""
    return docs(spark, folder).select("doc_id", F.round(T.token_estimate("text"), 6).alias("tokens"))


@R.add("truncated_60", f"select doc_id, case when text is null then '' when {NORMAL} = '' or len(string_split({NORMAL}, ' ')) <= 60 then text else array_to_string(list_slice(string_split({NORMAL}, ' '), 1, 60), ' ') end as head from documents")
def truncated_60(spark, folder):
    """TOK02, STR09 with words for tokens."""
    return docs(spark, folder).select("doc_id", T.truncate_words("text", 60).alias("head"))


@R.add("text_chunks", """select doc_id, i::integer as idx, substring(text, i::bigint * 1050 + 1, 1200) as chunk from (select doc_id, text, unnest(range(0, 1 + greatest(0, ceil((length(text) - 1200) / 1050.0))::bigint)) as i from documents where length(text) > 0)""")
def text_chunks(spark, folder):
    """CHK01, RET01, WIN13."""
    return retrieval.chunk_table(docs(spark, folder), "doc_id", "text").withColumnRenamed("text", "chunk")


@R.add("comma_lists", f"select doc_id, list_filter(list_transform(string_split(coalesce(text, ''), ','), lambda x: regexp_replace(x, '^{WS}+|{WS}+$', '', 'g')), lambda x: x <> '') as parts from documents")
def comma_lists(spark, folder):
    """STR05."""
    return docs(spark, folder).select("doc_id", T.comma_list("text").alias("parts"))


@R.add("first_lines", "select doc_id, regexp_split_to_array(text, '\\r\\n|[\\n\\r\\x{0b}\\x{0c}\\x{85}\\x{2028}\\x{2029}]')[1] as line from documents")
def first_lines(spark, folder):
    """STR11."""
    return docs(spark, folder).select("doc_id", T.first_line("text").alias("line"))


@R.add("chat_roles", "select log_id, case when lower(agent) in ('ai', 'assistant') then 'assistant' when lower(agent) = 'system' then 'system' else 'user' end as role from (select distinct log_id, agent from agent_log)")
def chat_roles(spark, folder):
    """STR14."""
    return table(spark, folder, "agent_log").select("log_id", "agent").distinct().select("log_id", T.chat_role("agent").alias("role"))


LOGS = "(select distinct log_id, content from agent_log where content is not null)"


def logs(spark, folder):
    return table(spark, folder, "agent_log").select("log_id", "content").where("content is not null").distinct()


@R.add(
    "json_replies",
    rf"""with b as (select log_id, regexp_extract(content, '(?s)\{{.*\}}', 0) as body from {LOGS}),
r as (select *, regexp_replace(regexp_replace(regexp_replace(replace(body, chr(39), '"'), '\bTrue\b', 'true', 'g'), '\bFalse\b', 'false', 'g'), '\bNone\b', 'null', 'g') as fixed from b)
select log_id, case when body = '' then null when json_valid(body) then md5(body) when json_valid(fixed) then md5(fixed) end as body_md5 from r""",
)
def json_replies(spark, folder):
    """The JSON objects in the agents' replies (JSN01, JSN02)."""
    return logs(spark, folder).select("log_id", F.md5(T.json_reply("content")).alias("body_md5"))


@R.add("json_repairs", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def json_repairs(spark, folder):
    """JSON out of replies in fences and with single quotes (JSN01)."""
    wrapped = F.concat(F.lit("Here it is:\n```json\n"), F.replace("props", F.lit('"'), F.lit("'")), F.lit("\n```"))
    return table(spark, folder, "events").select("event_id", F.from_json(T.json_reply(wrapped), "k bigint")["k"].alias("k"))


@R.add("info_needs", f"select log_id, lower(regexp_replace(regexp_extract(content, '(?s)<INFO_NEED>(.*?)</INFO_NEED>', 1), '^{WS}+|{WS}+$', '', 'g')) = 'true' as needed from {LOGS}")
def info_needs(spark, folder):
    """The flag in the agents' replies (XML01)."""
    return logs(spark, folder).select("log_id", T.needs_info("content").alias("needed"))


@R.add(
    "reader_requests",
    f"""with d as (select distinct log_id, component_id, content from agent_log where content is not null and regexp_matches(component_id, '^[A-Za-z_.0-9]+$'))
select log_id, component_id, [component_id] as classes, content like '%<CALL_BY>true</CALL_BY>%' as call_by, [split_part(component_id, '.', -1)] as queries from d where content like '%<REQUEST>%'""",
)
def reader_requests(spark, folder):
    """Requests of the agents' replies, with what they ask for put in from their component (XML02)."""
    rows = table(spark, folder, "agent_log").select("log_id", "component_id", "content").distinct().where(F.contains("content", F.lit("<REQUEST>")) & F.col("component_id").rlike("^[A-Za-z_.0-9]+$"))
    flag = F.regexp_extract("content", "<CALL_BY>[^<]*</CALL_BY>", 0)
    inner = F.concat(F.lit("<REQUEST><INTERNAL><CALLS><CLASS> "), "component_id", F.lit(" ,</CLASS></CALLS>"), flag, F.lit("</INTERNAL><RETRIEVAL><QUERY>"), T.last_segment("component_id"), F.lit("</QUERY></RETRIEVAL></REQUEST>"))
    asked = T.request(inner)
    return rows.select("log_id", "component_id", asked["classes"].alias("classes"), asked["call_by"].alias("call_by"), asked["queries"].alias("queries"))


@R.add("bare_requests", f"select log_id, [] :: varchar[] as classes, false as call_by, [] :: varchar[] as queries from {LOGS} where content like '%<REQUEST>%'")
def bare_requests(spark, folder):
    """The requests as the agents wrote them: none has INTERNAL and CALLS, so all of their fields are empty (XML02)."""
    asked = T.request("content")
    return logs(spark, folder).where(F.contains("content", F.lit("<REQUEST>"))).select("log_id", asked["classes"].alias("classes"), asked["call_by"].alias("call_by"), asked["queries"].alias("queries"))


@R.add("budgets", "select doc_id, cast(greatest(256, floor(greatest(256, n - 628) * 0.6)) as integer) as document, cast(greatest(32, floor(n * 0.12)) as integer) as title, cast(greatest(128, floor(n * 0.44)) as integer) as body, cast(greatest(128, n - greatest(32, floor(n * 0.12)) - greatest(128, floor(n * 0.44))) as integer) as context from (select doc_id, coalesce(n_chars, 0) as n from documents)")
def budgets(spark, folder):
    """TOK04."""
    rows = table(spark, folder, "documents").select("doc_id", F.coalesce("n_chars", F.lit(0)).alias("n"))
    parts = T.section_budgets("n")
    return rows.select("doc_id", T.doc_budget("n", F.lit(1000)).alias("document"), *[parts[c].alias(c) for c in ("title", "body", "context")])


BREAKS = "'\\r\\n|[\\n\\r\\x{0b}\\x{0c}\\x{85}\\x{2028}\\x{2029}]'"
#: The nodes of heading trees: ``n`` has (doc_id, ord, level, title, raw), ord 0 being the root.
HEADINGS = f"""with t as (select doc_id, regexp_split_to_array(regexp_replace(text, '(\\r\\n|[\\n\\r\\x{{0b}}\\x{{0c}}\\x{{85}}\\x{{2028}}\\x{{2029}}])$', ''), {BREAKS}) as a from documents where text is not null),
l as (select doc_id, unnest(a) as line, generate_subscripts(a, 1) as n from t),
h as (select *, regexp_matches(line, '^#{{1,6}}{WS}+.*$') as opens from l),
g as (select *, sum(opens::int) over (partition by doc_id order by n) as ord from h),
b as (select doc_id, 0 as ord, 0 as level, 'README' as title from t union all
  select doc_id, ord, length(regexp_extract(line, '^(#{{1,6}})', 1)), regexp_replace(regexp_extract(line, '^#{{1,6}}{WS}+(.*)$', 1), '^{WS}+|{WS}+$', '', 'g') from g where opens),
r as (select doc_id, ord, string_agg(line, chr(10) order by n) as raw from g where not opens group by all),
n as (select doc_id, cast(ord as integer) as ord, cast(level as integer) as level, title, regexp_replace(coalesce(raw, ''), '^{WS}+|{WS}+$', '', 'g') as raw from b left join r using (doc_id, ord))
"""


#: How many headings stand above each: those of a lower level than all between.
DEPTHS = "(select count(*) from n p where p.doc_id = n.doc_id and p.ord < n.ord and p.level < (select min(m.level) from n m where m.doc_id = n.doc_id and m.ord > p.ord and m.ord <= n.ord))"


@R.add("headings", HEADINGS + f"select n.*, (select max(p.ord) from n p where p.doc_id = n.doc_id and p.ord < n.ord and p.level < n.level) as parent_ord, cast({DEPTHS} as integer) as depth from n")
def headings(spark, folder):
    """Heading trees of documents (MD01)."""
    return trees.headings(docs(spark, folder), "doc_id", "text")


@R.add("heading_titles", f"""with l as (select doc_id, unnest(regexp_split_to_array(text, {BREAKS})) as line, generate_subscripts(regexp_split_to_array(text, {BREAKS}), 1) as n from documents where text is not null),
h as (select doc_id, n, length(regexp_extract(line, '^(#{{1,6}})', 1)) as level, regexp_replace(regexp_extract(line, '^#{{1,6}}{WS}+(.*)$', 1), '^{WS}+|{WS}+$', '', 'g') as title from l where regexp_matches(line, '^#{{1,6}}{WS}+.*$'))
select doc_id, cast(row_number() over (partition by doc_id order by n) as integer) as ord, cast(level as integer) as level, title from h""")
def heading_titles(spark, folder):
    """Headings of all documents in order (MD01)."""
    return trees.headings(docs(spark, folder), "doc_id", "text").where("level > 0").select("doc_id", "ord", "level", "title")


@R.add("outlines", HEADINGS + "select doc_id, string_agg(repeat(' ', greatest(0, 2 * (level - 1))) || '- ' || title, chr(10) order by ord) as text from n where level > 0 group by 1")
def outlines(spark, folder):
    """Headings as nested bullets (MD02, MD03)."""
    return trees.outline(headings(spark, folder), "doc_id")


@R.add(
    "context_outlines",
    HEADINGS
    + f""", d as (select *, {DEPTHS} as depth, list_filter(list_transform(string_split(raw, chr(10)), lambda x: regexp_replace(x, '{WS}+$', '')), lambda x: regexp_matches(x, '[^' || substr('{WS}', 2))) as own from n),
shown as (select doc_id, ord, repeat('  ', cast(depth - 1 as integer)) || '- **' || title || '**' || case len(own) when 0 then '' when 1 then ': ' || own[1] else ':' || array_to_string(list_transform(own, lambda x: chr(10) || repeat('  ', cast(depth as integer)) || x), '') end as line from d where depth > 0 and title <> '')
select doc_id, string_agg(line, chr(10) order by ord) as text from shown group by 1""",
)
def context_outlines(spark, folder):
    """Heading trees with their texts as nested bullets (MD03)."""
    return render.context_tree(headings(spark, folder).withColumnRenamed("raw", "summary"), ["doc_id"])


@R.add("recursive_chunks", None)
def recursive_chunks(spark, folder):
    """Documents split at the strongest separators (CHK02); tested on fixtures."""
    return retrieval.recursive_chunks(docs(spark, folder), "doc_id", "text")


@R.add("vocabulary_tokens", None)
def vocabulary_tokens(spark, folder):
    """Tokens of a public vocabulary and the text of the first hundred (TOK01, TOK02, TOK06); tested against the tokenizer."""
    encoder = vocabulary.Encoder(spark)
    return docs(spark, folder).select("doc_id", vocabulary.token_count(encoder, "text").alias("tokens"), vocabulary.truncate_tokens(encoder, "text", 100).alias("head"))


@R.add(
    "relevant_or_whole",
    f"""with w as (select doc_id, text, {NORMAL} as c from documents where text is not null), s as (select *, case when c = '' then 0 else len(string_split(c, ' ')) end * 1.3::double <= 60 as fits from w),
k as (select doc_id, i, substring(text, i * 180 + 1, 200) as piece from (select doc_id, text, unnest(range(0, 1 + greatest(0, ceil((length(text) - 200) / 180.0))::bigint)) as i from s where not fits and length(text) > 0)),
p as (select doc_id, i, regexp_replace(piece, '^{WS}+|{WS}+$', '', 'g') as piece from k), q(n, q) as (values (0, 'rows'), (1, 'checks')),
h as (select doc_id, i, piece, n, (length(lower(piece)) - length(replace(lower(piece), q, ''))) / length(q) as hits from p, q),
r as (select *, row_number() over (partition by doc_id, n order by hits desc, i) as place from h where hits > 0),
f as (select *, row_number() over (partition by doc_id, piece order by n, place) as first from r where place <= 2),
b as (select *, coalesce(sum(length(piece)) over (partition by doc_id order by n, place rows between unbounded preceding and 1 preceding), 0) as before from f where first = 1),
found as (select doc_id, string_agg(piece, chr(10) || chr(10) order by n, place) as text from b where before < 512 group by 1)
select doc_id, text from s where fits union all select * from found
union all select doc_id, case when len(string_split(c, ' ')) <= 46 then text else array_to_string(list_slice(string_split(c, ' '), 1, 46), ' ') end from s where not fits and doc_id not in (select doc_id from found)""",
)
def relevant_or_whole(spark, folder):
    """Short texts whole, of long ones what two queries find, else their beginning (RET08)."""
    return retrieval.relevant_or_whole(docs(spark, folder).where("text is not null"), [("rows", "rows"), ("checks", "checks")], "doc_id", "text", 2, 60, 200, 20)


@R.add(
    "role_prompts",
    f"""select repo_name, string_agg(case when agent = 'writer' then 'Assistant: ' when agent = 'reader' then 'System: ' else 'Human: ' end || coalesce(content, ''), chr(10) order by log_id) filter (where agent <> 'verifier') || chr(10) || 'Assistant: ' as prompt from {TURNS} group by 1""",
)
def role_prompts(spark, folder):
    """Conversations as prompts of models without roles (STR15)."""
    role = F.when(F.col("agent") == "writer", "ai").when(F.col("agent") == "reader", "system").when(F.col("agent") == "verifier", "tool").otherwise("human")
    return providers.prompts_of(turns(spark, folder).withColumn("role", role), "repo_name", "log_id")


@R.add(
    "summary_fields",
    """with s as (select distinct * from stage_b_file_summaries)
select repo_name, file, case when md5(file) < '2' then '(file summary unavailable)' else coalesce(nullif(file_summary, ''), '(no file summary)') end as file_summary,
  case when md5(file) < '2' then [] else coalesce(key_terms, []) end as key_terms, case when md5(file) < '2' then [] else coalesce(workflows, []) end as workflows from s""",
)
def summary_fields(spark, folder):
    """Summaries out of replies that hold their fields as JSON, some of them broken (AGG10, UDF07)."""
    rows = table(spark, folder, "stage_b_file_summaries").distinct()
    body = F.to_json(F.struct("file_summary", "key_terms", "workflows"), {"ignoreNullFields": "false"})
    reply = F.concat(F.lit("Here it is:\n```json\n"), F.when(F.md5("file") < "2", F.lit("{broken")).otherwise(body), F.lit("\n```"))
    return incremental.summary_fields(rows.select("repo_name", "file", reply.alias("reply")), "reply", "file")


@R.add("limited_items", "select distinct item_id from stage_b_function_items order by item_id limit 50")
def limited_items(spark, folder):
    """The first items of a run, as many as its user asks for (FIL11)."""
    return incremental.first_items(table(spark, folder, "stage_b_function_items").select("item_id").distinct(), 50, ["item_id"])


@R.add("substring_topk", """with q(query_id, q) as (values ('a', 'tide'), ('b', 'the voucher pool'), ('c', 'lagerfach')),
s as (select query_id, doc_id, cast((length(lower(text)) - length(replace(lower(text), q, ''))) / length(q) as integer) as hits from documents, q where text is not null),
r as (select *, row_number() over (partition by query_id order by hits desc, doc_id) as place from s where hits > 0) select query_id, doc_id, hits, place from r where place <= 4""")
def substring_topk(spark, folder):
    """RET04, WIN05."""
    asked = [("a", "tide"), ("b", "the voucher pool"), ("c", "lagerfach")]
    return retrieval.substring_search(docs(spark, folder), asked, "doc_id", "text", 4).withColumn("place", F.col("place").cast("long"))


@R.add("cosine_topk", """with n as (select vec_id, list_transform(embedding, lambda x: x::double / sqrt(list_sum(list_transform(embedding, lambda y: y::double * y::double)))) as v from embeddings),
s as (select q.vec_id as query_id, n.vec_id, list_sum(list_transform(list_zip(q.v, n.v), lambda p: p[1]::float::double * p[2]::float::double)) as sim from n q, n where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by round(sim, 9) desc, vec_id) as place from s) select query_id, vec_id, place from r where place <= 4""")
def cosine_topk(spark, folder):
    """Every hundredth vector against all, exact (RET02, RET03)."""
    vectors = table(spark, folder, "embeddings").select("vec_id", retrieval.normalized("embedding").alias("embedding"))
    asked = vectors.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    return retrieval.similar(asked, vectors, 4).select("query_id", "vec_id", F.col("place").cast("long").alias("place"))


@R.add("relevant_text", """with c as (select distinct * from rag_chunk where text is not null), q(n, q) as (values (0, 'reads'), (1, 'only'), (2, 'failed')),
s as (select source, idx, text, n, (length(lower(text)) - length(replace(lower(text), q, ''))) / length(q) as hits from c, q),
r as (select *, row_number() over (partition by source, n order by hits desc, idx) as place from s where hits > 0),
f as (select *, row_number() over (partition by source, text order by n, place) as first from r where place <= 4),
b as (select *, coalesce(sum(length(text)) over (partition by source order by n, place rows between unbounded preceding and 1 preceding), 0) as before from f where first = 1)
select source, string_agg(text, chr(10) || chr(10) order by n, place) as text from b where before < 2048 group by 1""")
def relevant_text(spark, folder):
    """What of each long source is relevant to three queries, within a budget (RET08, SET03)."""
    asked = [("purpose", "reads"), ("rules", "only"), ("risk", "failed")]
    chunks = table(spark, folder, "rag_chunk").where("text is not null").distinct()
    return retrieval.relevant_text(chunks, asked, "source", "idx", "text", 4, 2048)


@R.add("ordered_dedup_budget", """with d as (select source, idx, text, row_number() over (partition by source, text order by idx) as n from (select distinct source, idx, text from rag_chunk where text is not null)),
s as (select source, idx, text, coalesce(sum(length(text)) over (partition by source order by idx rows between unbounded preceding and 1 preceding), 0) as chars_before from d where n = 1)
select source, idx, cast(chars_before as bigint) as chars_before from s where chars_before < 3000""")
def ordered_dedup_budget(spark, folder):
    """SET03."""
    rows = table(spark, folder, "rag_chunk").where("text is not null").select("source", "idx", "text").distinct()
    return windows.ordered_dedup(rows, ["source"], ["idx"], "text", 3000).select("source", "idx", "chars_before")


@R.add("sliding_60s_usage", """select event_id, count(*) over w as events_in_window, round(sum(value) over w, 6) as value_in_window from events
window w as (partition by event_type order by ts range between interval 60 seconds preceding and current row)""")
def sliding_60s_usage(spark, folder):
    """WIN06."""
    used = windows.sliding_usage(table(spark, folder, "events"), ["event_type"], "ts", ["value"])
    return used.select("event_id", "events_in_window", F.round("value_in_window", 6).alias("value_in_window"))


@R.add("sliding_hour_usage", """select event_id, count(*) over w as events_in_window from events
window w as (partition by user_id order by ts range between interval 3600 seconds preceding and current row)""")
def sliding_hour_usage(spark, folder):
    return windows.sliding_usage(table(spark, folder, "events"), ["user_id"], "ts", [], 3600).select("event_id", "events_in_window")


@R.add("waits", """with u as (select event_id, event_type, ts, count(*) over w as n, min(ts) over w as oldest from events window w as (partition by event_type order by ts range between interval 3600 seconds preceding and current row))
select event_id, round(case when n > 2 * 0.9 then greatest(0, 3600 - date_diff('microsecond', oldest, ts) / 1e6) else 0 end, 6) as wait_s from u""")
def waits(spark, folder):
    """How long a request must wait for room in its window (WIN07)."""
    used = windows.sliding_usage(table(spark, folder, "events"), ["event_type"], "ts", [], 3600)
    return windows.waits(used, "ts", {"events_in_window": 2}, ["event_type"], 3600).select("event_id", "wait_s")


@R.add(
    "admissions",
    """with recursive e as (select event_type || '-' || user_id as key, event_id, cast(epoch_us(ts) // 1000 as bigint) as at_ms, cast(length(props) as bigint) as n from events),
o as (select *, row_number() over (partition by key order by at_ms, event_id) as k from e),
w as (select distinct key, cast(0 as bigint) as k, cast([] as struct(s bigint, n bigint)[]) as starts, cast(null as bigint) as event_id, cast(null as bigint) as wait_ms from e
  union all
  select key, k, list_append(list_filter(live, lambda x: x.s > start_at - 3600000), struct_pack(s := start_at, n := n)), event_id, start_at - at_ms
  from (select *, case when j = 0 then base else live[j].s + 3600000 end as start_at
    from (select *, list_filter(range(0, len(live) + 1), lambda i: len(live) - i < 4 and (len(live) = i or list_sum(list_transform(live[i + 1:], lambda x: x.n)) + n <= 900))[1] as j
      from (select *, list_filter(starts, lambda x: x.s > base - 3600000) as live
        from (select o.key, o.k, o.event_id, o.at_ms, o.n, w.starts, greatest(o.at_ms, coalesce(w.starts[-1].s, o.at_ms)) as base from w join o on o.key = w.key and o.k = w.k + 1)))))
select key, event_id, wait_ms from w where event_id is not null""",
)
def admissions(spark, folder):
    """Admission one after another under limits per type, with back-pressure (WIN07, STM04)."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    asked = table(spark, folder, "events").select(F.concat_ws("-", "event_type", "user_id").alias("key"), "event_id", (micros / 1000).cast("long").alias("at"), F.length("props").cast("long").alias("tokens"))
    return jobs.admit(asked, "key", "event_id", "at", "tokens", 5, 1000, 3600)


@R.add("running_cost", """select event_id, cast(sum(length(props)) over w as bigint) as running_tokens, round(sum(length(props)) over w * 3.0 / 1e6, 9) as running_cost from events window w as (partition by user_id order by ts, event_id rows unbounded preceding)""")
def running_cost(spark, folder):
    """AGG17, WIN08."""
    rows = table(spark, folder, "events").withColumn("tokens", F.length("props"))
    return windows.running_cost(rows, ["user_id"], "ts", ["event_id"], "tokens", 3.0).select("event_id", "running_tokens", "running_cost")


@R.add("usage_totals", "select event_type, count(*) as calls, cast(sum(length(props)) as bigint) as tokens, round(sum(length(props)) * 3.0 / 1e6, 9) as cost from events group by 1")
def usage_totals(spark, folder):
    return table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("calls"), F.sum(F.length("props")).alias("tokens"), F.round(T.price(F.sum(F.length("props")), F.lit(3.0)), 9).alias("cost"))


@R.add("batch_numbers", "select repo_name, item_id, cast(floor((row_number() over (partition by repo_name order by item_id) - 1) / 50) + 1 as integer) as batch from (select distinct repo_name, item_id from stage_b_function_items)")
def batch_numbers(spark, folder):
    """WIN09."""
    rows = table(spark, folder, "stage_b_function_items").select("repo_name", "item_id").distinct()
    return windows.batch_numbers(rows, ["repo_name"], ["item_id"])


@R.add("role_collapse", f"select repo_name, log_id, agent from (select *, lag(agent) over (partition by repo_name order by log_id) as b from {TURNS}) where b is null or b <> agent")
def role_collapse(spark, folder):
    """WIN11."""
    return windows.collapse_roles(turns(spark, folder), "repo_name", "log_id", "agent").select("repo_name", "log_id", "agent")


@R.add("last_turns", f"select repo_name, arg_max(agent, log_id) = 'writer' as ok from {TURNS} group by 1")
def last_turns(spark, folder):
    rows = turns(spark, folder).withColumn("role", F.when(F.col("agent") == "writer", "user").otherwise("assistant"))
    return windows.ends_with_user(rows, "repo_name", "log_id", "role")


@R.add("budget_suffix", f"select repo_name, log_id from (select *, sum(coalesce(length(content), 0)) over (partition by repo_name order by log_id desc rows unbounded preceding) as s from {TURNS}) where s <= 4000")
def budget_suffix(spark, folder):
    """Newest turns within a budget (WIN10)."""
    rows = turns(spark, folder).withColumn("cost", F.coalesce(F.length("content"), F.lit(0)))
    return windows.newest_within(rows, "repo_name", "log_id", "cost", 4000).select("repo_name", "log_id")


@R.add("fitted_conversations", rf"""with recursive t as (select repo_name, log_id, case when agent = 'writer' then 'user' else 'assistant' end as role, coalesce(content, '') as content,
  row_number() over (partition by repo_name order by log_id desc) as k from {TURNS}),
c as (select *, cast(trunc(len(regexp_extract_all(content, '[^' || substr('{WS}', 2) || '+')) * 1.3::double) as bigint) + 6 as need from t),
w as (select repo_name, cast(0 as bigint) as k, cast(798 as bigint) as left_, cast(null as bigint) as log_id, cast(null as varchar) as role, cast(null as varchar) as content, cast(null as boolean) as cut, false as done from (select distinct repo_name from t)
  union all
  select repo_name, k, left_ - case when need <= left_ then need when short_need <= left_ then short_need else 0 end, case when need <= left_ or short_need <= left_ then log_id end, role,
    case when need <= left_ then content else short end, need > left_, left_ - case when need <= left_ then need when short_need <= left_ then short_need else 0 end <= 20
  from (select *, cast(trunc(len(regexp_extract_all(short, '[^' || substr('{WS}', 2) || '+')) * 1.3::double) as bigint) + 6 as short_need from (
    select w.repo_name, c.k, w.left_, c.log_id, c.role, c.content, c.need, case when c.role = 'user' and w.left_ > 20 and c.need > w.left_ then
      case when w.left_ / c.need < 0.5 then '[...truncated...] ' else '' end || regexp_replace(substring(c.content, cast(trunc(length(c.content) * (1 - w.left_::double / c.need + case when w.left_::double / c.need < 0.5 then 0.1::double else 0 end)) as bigint) + 1), '^{WS}+|{WS}+$', '', 'g') end as short
    from w join c on c.repo_name = w.repo_name and c.k = w.k + 1 where not w.done)))
select repo_name, log_id, role, content, cut from w where log_id is not null""")
def fitted_conversations(spark, folder):
    """The exact greedy walk with cut turns (WIN10)."""
    rows = turns(spark, folder).select("repo_name", "log_id", F.when(F.col("agent") == "writer", "user").otherwise("assistant").alias("role"), F.coalesce("content", F.lit("")).alias("content"))
    return windows.fit_conversation(rows, "repo_name", "log_id", "role", "content", 800)


@R.add("message_tokens", f"""select repo_name, cast(sum(floor(round(case when c = '' then 0 else len(string_split(c, ' ')) end * 1.3, 6)) + 4) + 2 as bigint) as tokens
from (select repo_name, regexp_replace(regexp_replace(coalesce(content, ''), '{WS}+', ' ', 'g'), '^ | $', '', 'g') as c from {TURNS}) group by 1""")
def message_tokens(spark, folder):
    """TOK03."""
    return windows.message_tokens(turns(spark, folder), "repo_name", "content")


@R.add("longest_sections", "select source, arg_max(idx, struct_pack(a := coalesce(length(text), 0), b := -idx)) as idx from (select distinct source, idx, text from rag_chunk) group by 1")
def longest_sections(spark, folder):
    """AGG19, TOK05."""
    rows = table(spark, folder, "rag_chunk").select("source", "idx", F.coalesce(F.length("text"), F.lit(0)).alias("n")).distinct()
    return windows.longest_section(rows, ["source"], "idx", "n")


@R.add("context_sections", """select source, string_agg('<' || section || '>' || chr(10) || body || chr(10) || '</' || section || '>', chr(10) order by section) as text from (
select source, 'PART' || (idx % 2) as section, string_agg(md5(coalesce(text, '')), chr(10) order by idx, md5(coalesce(text, ''))) as body from (select distinct source, idx, text from rag_chunk) group by all) group by source""")
def context_sections(spark, folder):
    """Sections of a context, rounds appended (XML03, SET06)."""
    from quernel.operators.render import context_sections as build

    rows = table(spark, folder, "rag_chunk").select("source", "idx", "text").distinct()
    rows = rows.select("source", F.concat(F.lit("PART"), F.col("idx") % 2).alias("section"), F.col("idx").alias("round"), F.md5(F.coalesce("text", F.lit(""))).alias("content"))
    return build(rows, ["source"])


@R.add("clocks", "select event_id, printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) as clock from (select event_id, cast(floor(abs(value)) as bigint) as s from events)")
def clocks(spark, folder):
    """MAT02."""
    return table(spark, folder, "events").select("event_id", T.clock(F.abs("value")).alias("clock"))


@R.add("iso_days", "select event_id, strftime(ts, '%Y-%m-%d') as day, strftime(ts, '%Y-%m-%dT%H:%M:%S') as moment from events")
def iso_days(spark, folder):
    """DAT01, DAT02."""
    return table(spark, folder, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("moment"))


@R.add("name_lists", "select repo_name, file, case when len(key_terms) > 6 then array_to_string(key_terms[1:6], ', ') || ', +' || (len(key_terms) - 6) || ' more' else array_to_string(key_terms, ', ') end as terms from (select distinct repo_name, file, key_terms from stage_b_file_summaries)")
def name_lists(spark, folder):
    """ARR01, WIN14."""
    from quernel.operators.fold import more

    return table(spark, folder, "stage_b_file_summaries").select("repo_name", "file", "key_terms").distinct().select("repo_name", "file", more("key_terms", 6).alias("terms"))


@R.add("glossaries", "select repo_name, file, array_to_string(list_transform(coalesce(key_terms, []), lambda x: '- ' || x || ': ' || length(x)), chr(10)) as text from (select distinct repo_name, file, key_terms from stage_b_file_summaries)")
def glossaries(spark, folder):
    """MAP01, FIL14."""
    rows = table(spark, folder, "stage_b_file_summaries").select("repo_name", "file", "key_terms").distinct()
    entries = F.transform(T.as_list("key_terms"), lambda t: F.struct(t.alias("key"), F.length(t).cast("string").alias("value")))
    return rows.select("repo_name", "file", T.glossary(entries).alias("text"))


@R.add("links", "select repo_name, file, '[' || file || '](pages/' || file || '.md)' as link from (select distinct repo_name, file from stage_b_file_summaries)")
def links(spark, folder):
    """STR04."""
    return table(spark, folder, "stage_b_file_summaries").select("repo_name", "file").distinct().select("repo_name", "file", T.md_link("file", F.concat(F.lit("pages/"), "file", F.lit(".md"))).alias("link"))


REPOS = """(select repo_name as full_name, count(*) as stars, count(distinct relative_path) as forks, min(scan_time) as created_at, bool_or(deleted_at is not null and scan_time > timestamp '2025-06-01') as archived,
  100.0 * count(*) filter (where component_type ilike '%method%') / count(*) as python_share, case when count(*) % 2 = 0 then 'Python' else 'Text' end as language from dependency_graph where repo_name is not null group by 1)"""


def repositories(spark, folder):
    """Metadata of repositories out of their components: scans as stars, files as forks, the share of methods as that of Python."""
    rows = table(spark, folder, "dependency_graph").where("repo_name is not null").groupBy("repo_name").agg(
        F.count(F.lit(1)).alias("stars"),
        F.count_distinct("relative_path").alias("forks"),
        F.min("scan_time").alias("created_at"),
        F.bool_or(F.col("deleted_at").isNotNull() & (F.col("scan_time") > F.lit("2025-06-01").cast("timestamp_ntz"))).alias("archived"),
        (F.count_if(F.contains(F.lower("component_type"), F.lit("method"))) * 100.0 / F.count(F.lit(1))).alias("python_share"),
        F.when(F.count(F.lit(1)) % 2 == 0, "Python").otherwise("Text").alias("language"),
    )
    return rows.withColumnRenamed("repo_name", "full_name")


@R.add("repository_search", f"select full_name, stars from {REPOS} where stars > 20 and forks > 3 and created_at > timestamp '2020-01-01' and created_at < timestamp '2030-01-01' and not coalesce(archived, false) and python_share >= 10 order by stars desc, full_name limit 50")
def repository_search(spark, folder):
    """Search conditions, sort and limit (SRC14, FIL06, FIL07, WIN15)."""
    asked = {"stars": {"min": 20}, "forks": {"min": 3}, "created_after": "2020-01-01", "created_before": "2030-01-01", "archived": False, "min_python": 10, "sort": "stars", "limit": 50}
    return readers.search(repositories(spark, folder), asked).select("full_name", "stars")


@R.add("owner_search", f"select full_name, forks from {REPOS} where split_part(full_name, '/', 1) in ('quillmere', 'lumen-yard', 'sedgeway') and lower(language) = 'python' order by forks, full_name limit 20")
def owner_search(spark, folder):
    """By owner and language, ascending (SRC14, FIL06, FIL07, WIN15)."""
    asked = {"owners": ["quillmere", "lumen-yard", "sedgeway"], "language": ["Python"], "sort": "forks", "order": "asc", "limit": 20}
    return readers.search(repositories(spark, folder), asked).select("full_name", "forks")


@R.add("base64_texts", "select doc_id, coalesce(text, '') as text from documents")
def base64_texts(spark, folder):
    """SRC15."""
    return docs(spark, folder).select("doc_id", readers.decoded(F.base64(F.encode("text", "UTF-8"))).alias("text"))


@R.add("python_shares", """with f as (select distinct repo_name, relative_path, content from source_files where content is not null and relative_path is not null),
s as (select repo_name, sum(strlen(content)) as total, sum(strlen(content)) filter (where md5(relative_path) < '8') as own from f group by 1)
select repo_name, round(100.0 * coalesce(own, 0) / total, 6) as share from s where total > 0""")
def python_shares(spark, folder):
    """Shares of bytes by language, where half of the files by their paths' digest stand for another language (AGG16)."""
    files = table(spark, folder, "source_files").select("repo_name", "relative_path", "content").where("content is not null and relative_path is not null").distinct()
    by = files.groupBy("repo_name", F.when(F.md5("relative_path") < "8", "Python").otherwise("C").alias("language")).agg(F.sum(F.octet_length("content")).alias("n"))
    maps = by.groupBy("repo_name").agg(F.map_from_entries(F.collect_list(F.struct("language", "n"))).alias("sizes"))
    return maps.select("repo_name", F.round(readers.python_share("sizes"), 6).alias("share")).where("share is not null")


@R.add("done_keys", "select distinct component_id from agent_log where agent = 'writer' and component_id is not null")
def done_keys(spark, folder):
    """The keys in an output of JSON lines, read tolerantly (SRC05, SNK03)."""
    import uuid

    out = f"{checkpoint_dir(spark)}/done-{uuid.uuid4().hex}"
    sinks.append_rows(table(spark, folder, "agent_log").where("agent = 'writer'").select("component_id", "content"), out)
    return readers.done_keys(spark, out)


@R.add("usage_in_windows", """select time_bucket(interval 10 seconds, ts) - interval (10 * i) second as start, event_type, count(*) as events, round(sum(value), 6) as value from events, range(0, 6) r(i) group by all""")
def usage_in_windows(spark, folder):
    """The sliding windows of the streaming form, over a table (STM04)."""
    used = jobs.usage_stream(table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"], ["value"], 60, 10)
    return used.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "events", F.round("value", 6).alias("value"))


@R.add("message_tokens_by_provider", f"""with m as (select repo_name, floor(round(case when c = '' then 0 else len(string_split(c, ' ')) end * 1.3, 6)) as n
  from (select repo_name, regexp_replace(regexp_replace(coalesce(content, ''), '{WS}+', ' ', 'g'), '^ | $', '', 'g') as c from {TURNS}))
select repo_name, provider, cast(sum(n + e) + f as bigint) as tokens from m, (values ('claude', 10, 0), ('gemini', 4, 0), ('local', 4, 2), ('openai', 4, 3)) v(provider, e, f) group by repo_name, provider, f""")
def message_tokens_by_provider(spark, folder):
    """The overheads of four providers (TOK03)."""
    rows = turns(spark, folder)
    parts = [windows.message_tokens(rows, "repo_name", "content", *o).withColumn("provider", F.lit(p)) for p, o in windows.OVERHEADS.items()]
    return retrieval.gather(parts)


@R.add("similar_texts", """with p as (select n_chars, doc_kind, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^[\\s\\x{0b}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+|[\\s\\x{0b}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+$', '', 'g')), lambda x: x <> ''), chr(10)) as tidy, min(doc_id) as id
  from documents where text is not null group by 1, 2, 3),
m as (select a.id as a, b.id as b, a.tidy as x, b.tidy as y, greatest(length(a.tidy), length(b.tidy)) as n from p a join p b on a.n_chars = b.n_chars and a.doc_kind = b.doc_kind and a.id < b.id where least(length(a.tidy), length(b.tidy)) >= 0.9 * greatest(length(a.tidy), length(b.tidy))),
s as (select a, b, round(len(list_filter(range(1, n + 1), lambda i: substring(x, i, 1) = substring(y, i, 1) and i <= length(x) and i <= length(y))) / n, 6) as similarity from m where n > 0)
select a, b, similarity from s where similarity >= 0.9""")
def similar_texts(spark, folder):
    """Texts of one kind and length that agree sign for sign in nine of ten places (JN18)."""
    return lookups.similar_pairs(table(spark, folder, "documents").where("text is not null"), "doc_id", "text", ["n_chars", "doc_kind"])
