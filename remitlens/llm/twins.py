"""The queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from remitlens.llm import chat, quality_rules, secret_scan

EXACT = r"""
with plain as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t, from documents
), ranked as (
  select doc_id, t, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
         row_number() over (partition by t order by doc_id) as n
  from plain
)
select doc_id, keep_id, group_size, n = 1 as kept, sha256(t) as text_sha256 from ranked
"""

LINES = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as n
  from documents
), keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines
), owned as (
  select *, length(k) >= 10 and doc_id > min(doc_id) over (partition by k) as gone from keyed
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by n) filter (not gone), '')) as kept_sha256
from owned group by doc_id
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def chat_sql() -> str:
    """Lengths of examples follow from the turns: an escaped character takes two more."""
    heads, tail = len(chat.START) + 1, len(chat.END)

    def size(column: str) -> str:
        marks = (r"%(25|3C|5B|0A)", r"<(\|im_start\|>|\|im_end\|>|s>|/s>|<SYS>>|</SYS>>)", r"\[/?INST\]")
        return f"length({column})" + "".join(f" + 2 * len(regexp_extract_all({column}, {_quoted(m)}))" for m in marks)

    return f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as n,
    {heads} + {size("role")} + 2 * (length(role) - length(replace(role, chr(10), ''))) + {size("text")} + {tail} as size
  from rows
), ends as (
  select *, sum(size) over (partition by conv_id order by n) as upto,
    role = 'assistant' or n = count(*) over (partition by conv_id) as is_end
  from turns
)
select conv_id, count(*) as n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' order by n)) as turns_sha256,
  length(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(upto) filter (is_end) as bigint) as formatted_chars
from ends group by conv_id
"""


def secrets_sql() -> str:
    """Each match with the gap before it; lengths of both, summed up, are its place. Blocks go on behind their first mark."""
    rules = [*secret_scan.BASE, *secret_scan.MORE]
    parts = []
    for rank, rule in enumerate(rules):
        guard = f"from docs where regexp_matches(text, {_quoted(rule.pattern)})"
        if isinstance(rule, secret_scan.Block):
            marks, gaps = f"regexp_extract_all(text, {_quoted(rule.pattern)})", f"string_split_regex(text, {_quoted(rule.pattern)})"
            parts.append(f"""
  select rid, {rank} as rank, '{rule.kind}' as kind, gap, mark as hit, n, {_begins("mark", rule.first, rule)} as counts,
    {_behind(rule)} as more
  from (select rid, unnest(gaps[:-2]) as gap, unnest(marks) as mark, unnest(gaps[2:]) as next_gap,
      unnest(list_append(marks[2:], '')) as next_mark, generate_subscripts(marks, 1) as n
    from (select rid, {marks} as marks, {gaps} as gaps {guard}))""")
            continue
        whole = _quoted(f"(?s)(.*?)({rule.pattern})")
        parts.append(f"""
  select rid, {rank} as rank, '{rule.kind}' as kind, gap, hit, n, length(value) >= {rule.least} as counts, 0 as more
  from (select rid, unnest(regexp_extract_all(text, {whole}, 1)) as gap, unnest(regexp_extract_all(text, {whole}, 2)) as hit,
      unnest(regexp_extract_all(text, {whole}, {2 + rule.value})) as value,
      generate_subscripts(regexp_extract_all(text, {whole}, 2), 1) as n {guard})""")
    listed = "string_agg(concat(kind, ':', start, ':', stop), ',' order by start, rank)"
    counts = ", ".join(f"count(*) filter (kind = '{rule.kind}') as n_{rule.kind}" for rule in secret_scan.BASE)
    kinds = ", ".join(f"'{rule.kind}'" for rule in secret_scan.BASE)
    return f"""
with docs as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents
), matches as ({" union all ".join(parts)}
), placed as (
  select *, cast(sum(length(gap) + length(hit)) over (partition by rid, rank order by n) as bigint) as upto from matches
), spans as (
  select rid, rank, kind, upto - length(hit) as start, upto + more as stop from placed where counts
), found as (
  select rid, {counts}, {listed} filter (kind in ({kinds})) as base, {listed} as spans from spans group by rid
)
select doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0) as n_{rule.kind}" for rule in secret_scan.BASE)},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join found using (rid)
"""


def _begins(mark: str, head: str, rule: secret_scan.Block) -> str:
    return f"(starts_with({mark}, '{head}') and ends_with({mark}, '{rule.ends}'))"


def _behind(rule: secret_scan.Block) -> str:
    """How far a block goes on behind its first mark: to the end of the next mark, or over the parts that follow."""
    cut = f"regexp_extract_all(next_gap, {_quoted(rule.parts())})"
    own = f"list_filter({cut}, lambda x: regexp_matches(x, {_quoted('^' + rule.part)}))"
    rest = f"case when len({own}) < len({cut}) then {cut}[-1] else '' end"
    short = f"case when regexp_matches({own}[-1], {_quoted(rule.field)}) then 0 else length(regexp_extract({rest}, {_quoted(rule.short)}, 1)) end"
    parts = f"length(array_to_string({own}, '')) + case when len({own}) > 0 then {short} else 0 end"
    return f"case when {_begins('next_mark', rule.last, rule)} then length(next_gap) + length(next_mark) else {parts} end"


def quality_sql() -> str:
    """Counts, histograms by language, two rounds of sums, and distances rounded as the query rounds them."""
    languages = list(quality_rules.COMMON.items())
    width = max(len(words) for _, words in languages)

    def common(i: int) -> str:
        cases = " ".join(f"when '{name}' then len(list_filter(w, lambda x: x = '{words[i]}'))" for name, words in languages)
        return f"case lang {cases} end as w{i}"

    classes = list(quality_rules.CLASSES.values())
    counted = ", ".join(
        f"length(text) - length(regexp_replace(text, {_quoted(p)}, '', 'g')) as c{i}" for i, p in enumerate([*classes, quality_rules.SYMBOLS])
    )
    n_classes = len(classes) + 1
    chars = [f"c{i}" for i in range(n_classes)] + ["c_rest"]
    words = [f"w{i}" for i in range(width)] + ["w_rest"]

    def distance(columns: list[str]) -> str:
        p, q = "({0} / cast({1} as double))", "(u.{0} / cast({1} as double))"
        whole_p, whole_q = "(" + " + ".join(columns) + ")", "(" + " + ".join(f"u.{c}" for c in columns) + ")"
        terms = []
        for c in columns:
            a, b = p.format("m." + c, whole_p.replace("(", "(m.").replace(" + ", " + m.")), q.format(c, whole_q)
            mid = f"(({a} + {b}) / 2)"
            terms += [f"case when {x} > 0 then {x} * log2({x} / {mid}) / 2 else 0 end" for x in (a, b)]
        return "round(sqrt(greatest(" + " + ".join(terms) + ", 0)), 9)"

    def judged(name: str, source: str) -> str:
        sums = ", ".join(f"sum({c}) as {c}" for c in [*chars, *words])
        return f"""
{name}_usual as (select language, {sums} from {source} where not base_failed group by language),
{name} as (
  select m.*, case when m.n_words >= {quality_rules.LEAST_WORDS} and u.language is not null then {distance(chars)} end as chars_distance,
    case when m.n_words >= {quality_rules.GUARD_WORDS} and u.language is not null and m.language <> 'other' then {distance(words)} end
      as words_distance
  from measured m left join {name}_usual u on u.language = m.language)"""

    guard, span = quality_rules.GUARD_WORDS, float(quality_rules.GUARD_WORDS - quality_rules.LEAST_WORDS)
    most = (
        f"case when n_words >= {guard} then {quality_rules.MOST_CHARS}"
        f" else cast({quality_rules.SHORT_CHARS} as double) + cast({quality_rules.WIDER} as double) * ({guard} - n_words) / {span} end"
    )
    fits = (
        f"coalesce(chars_distance, 0) <= {most} and coalesce(words_distance, 0) <= {quality_rules.MOST_WORDS}"
        f" and coalesce(chars_distance, 0) + coalesce(words_distance, 0) <= {quality_rules.MOST_TOGETHER}"
    )
    window = quality_rules.WINDOW
    known = ", ".join(f"'{name}'" for name, _ in languages)
    return f"""
with docs as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text, case when lang in ({known}) then lang else 'other' end as lang,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents
), windows as (
  select rid, i, count(*) over (partition by rid, key) as times
  from (select rid, i, array_to_string(w[i : i + {window - 1}], ' ') as key
    from (select rid, w, unnest(range(1, len(w) - {window - 2})) as i from docs))
), repeated as (
  select rid, count(distinct i + k) as n_repeat_words
  from windows, (select unnest(range(0, {window})) as k) where times > 1 group by rid
), counted as (
  select rid, doc_id, lang as language, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) as n_dup_lines,
    {counted}, {", ".join(common(i) for i in range(width))}
  from docs
), measured as (
  select counted.* exclude ({", ".join(words[:-1])}), {", ".join(f"coalesce({c}, 0) as {c}" for c in words[:-1])},
    word_chars - {" - ".join(chars[:-1])} as c_rest, n_words - {" - ".join(f"coalesce({c}, 0)" for c in words[:-1])} as w_rest,
    coalesce(n_repeat_words, 0) as n_repeat_words,
    n_words < {quality_rules.LEAST_WORDS} or 100 * coalesce(n_repeat_words, 0) > {quality_rules.MOST_REPEATED} * n_words as base_failed
  from counted left join repeated using (rid)
), {judged("first", "measured")}, near as (select * from first where {fits}), {judged("last", "near")}
select doc_id, n_words, word_chars, c{n_classes - 1} as n_symbols, n_dup_lines, n_repeat_words, base_failed, chars_distance,
  words_distance, not base_failed and {fits} as kept
from last
"""


# CRC-32 of a short text, a byte after the other and eight steps for each.
_CRC = """xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split({0}, ''), lambda c: cast(ascii(c) as bigint))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""

TRIE = f"""
with own as (
  select conv_id, list({{'role': role, 'text': text}} order by turn nulls first, role, text) as turns
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)
  group by conv_id
), counted as (
  select *, {_CRC.format("cast(conv_id as varchar)")} % 6 as h from own
), rebuilt as (
  select c.conv_id, list_concat(coalesce(b.turns[1 : h], []), c.turns[h + 1 :]) as turns
  from counted c left join own b on b.conv_id = c.conv_id - c.conv_id % 100
), members as (
  select conv_id, d, turns[1 : d] as node, d = len(turns) as ends
  from (select *, unnest(range(0, len(turns) + 1)) as d from rebuilt)
), nodes as (
  select d, node, min(conv_id) as conv_id, count(*) as n_convs,
    string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends) as ended
  from members group by d, node
), children as (
  select d - 1 as d, node[1 : d - 1] as node, count(*) as n_children from nodes where d > 0 group by all
), whole as (
  select n.*, coalesce(n_children, 0) as n_children, coalesce((n_convs - 1) * length(n.node[d].text), 0) as saved
  from nodes n left join children c using (d, node)
), subtrees as (
  select up as d, node[1 : up] as node, sum(saved) as saved_tokens, count(*) filter (n_children = 0) as n_leaves
  from (select *, unnest(range(0, d + 1)) as up from whole) group by all
)
select w.conv_id, w.d as depth, p.conv_id as parent_conv_id, w.n_convs, w.n_children, n_leaves,
  cast(saved_tokens as bigint) as saved_tokens, sha256(coalesce(w.ended, '')) as ends_sha256
from whole w join subtrees s using (d, node) left join nodes p on p.d = w.d - 1 and p.node = w.node[1 : w.d - 1]
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": EXACT,
        "op5_chat": chat_sql(),
        "op8_quality_rules": quality_sql(),
        "op9_secrets": secrets_sql(),
        "op10_line_dedup": LINES,
        "op11_prefix_trie": TRIE,
    }
