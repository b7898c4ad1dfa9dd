"""The queries that SQL can express, in DuckDB's dialect, written apart from the operators."""

from __future__ import annotations

from .quality_rules import HIGH, ITERATIONS, KEPT, LOW, RIGHT, RULES, SHARE


def _quality_rules() -> str:
    votes = [f"vote_{n}" for n in RULES]
    cases = ", ".join(f"case when {bad} then 0 when {good} then 1 end vote_{n}"
                      for n, (bad, good) in RULES.items())
    start = ", ".join(f"{RIGHT}::double {v}_g, {1 - RIGHT}::double {v}_b" for v in votes)

    def log_odds(side: str, share: str) -> str:
        return " + ".join([f"ln({share})"] + [
            f"case {v} when 1 then ln({v}_{side}) when 0 then ln(1 - {v}_{side}) else 0 end"
            for v in votes])

    p = f"1 / (1 + exp(({log_odds('b', '1 - share')}) - ({log_odds('g', 'share')})))"
    steps = []
    for i in range(ITERATIONS):
        new = ", ".join(
            f"""least(greatest((coalesce(sum(n * w_{k}) filter ({v} = 1), 0) + {a})
                / (coalesce(sum(n * w_{k}) filter ({v} = 0), 0)
                   + coalesce(sum(n * w_{k}) filter ({v} = 1), 0) + 1), {lo}), {hi}) {v}_{k}"""
            for v in votes for k, a, lo, hi in (("g", RIGHT, 0.5, HIGH), ("b", 1 - RIGHT, LOW, 0.5)))
        steps.append(f"""e{i} as materialized (select t.*, {p} w_g, 1 - ({p}) w_b from t, p{i}),
            p{i + 1} as materialized (select least(greatest(sum(n * w_g) / sum(n), {LOW}), {HIGH})
                share, {new} from e{i})""")
    return rf"""
    with base as (
        select doc_id, coalesce(text, '') txt, list_filter(regexp_split_to_array(
                coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') words,
            list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) lines
        from documents),
    grams as (
        select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] gram
        from base, unnest(range(1, len(words) - 1)) u(i)),
    again as (select doc_id, i from grams qualify count(*) over (partition by doc_id, gram) > 1),
    repeats as (
        select doc_id, count(distinct i + k) n from again, unnest([0, 1, 2]) u(k) group by doc_id),
    m as (
        select doc_id, len(words)::bigint n_words,
            length(regexp_replace(txt, '[\x20\x09-\x0D]', '', 'g'))::bigint word_chars,
            length(regexp_replace(txt, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols,
            length(regexp_replace(txt, '[^.!?]', '', 'g'))::bigint n_stops,
            length(regexp_replace(txt, '[^A-Z]', '', 'g'))::bigint n_capitals,
            length(regexp_replace(txt, '[^A-Za-z]', '', 'g'))::bigint n_letters,
            len(lines)::bigint n_lines, (len(lines) - len(list_distinct(lines)))::bigint n_dup_lines,
            coalesce(n, 0)::bigint n_repeat_words
        from base left join repeats using (doc_id)),
    v as (select *, {cases} from m),
    t as materialized (select {', '.join(votes)}, count(*) n from v group by all),
    p0 as materialized (select {SHARE}::double share, {start}),
    {', '.join(steps)},
    scored as (select v.*, {p} posterior,
            n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from v, p{ITERATIONS})
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not base_failed and posterior >= {KEPT} kept, round(posterior, 4) posterior
    from scored"""


_URL_FILTERS = r"""
    with rules(rule, verdict) as (values ('com/', 'allow'), ('example.com/en/', 'block'),
        ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')),
    cut as (
        select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3)
            else '' end rest from pages),
    urls as (
        select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') host,
            coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') path from cut)
    select page_id, host, path, max_by(rule, length(rule)) rule,
        coalesce(max_by(verdict, length(rule)), 'allow') verdict
    from urls left join rules on ('.' || host) like ('%.' || split_part(rule, '/', 1))
        and starts_with(path, substr(rule, strpos(rule, '/')))
    group by page_id, host, path"""

_DECONTAMINATION = r"""
    with words as (
        select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w from documents),
    items as (
        select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w from benchmark),
    windows as (
        select distinct item_id, least(len(w), 10) size,
            array_to_string(w[i:i + least(len(w), 10) - 1], ' ') span
        from items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) u(i) where len(w) > 0),
    spans as (
        select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') span
        from words, (select distinct size from windows), unnest(range(1, len(w) - size + 2)) u(i)),
    found as (select doc_id, item_id, i, s.size from spans s join windows using (size, span)),
    hits as (
        select doc_id, count(distinct i + k) n_hit from found, unnest(range(0, size)) u(k)
        group by doc_id),
    named as (
        select doc_id, count(*) n_items, sha256(string_agg(item_id::varchar, ',' order by
            item_id::varchar)) items_sha256
        from (select distinct doc_id, item_id from found) group by doc_id)
    select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit,
        coalesce(n_items, 0)::bigint n_items, coalesce(items_sha256, sha256('')) items_sha256,
        coalesce(n_hit, 0) > 0 contaminated
    from words left join hits using (doc_id) left join named using (doc_id)"""



def _runs(kind: str, source: str, pattern: str) -> str:
    """Matches of ``pattern`` with their place: they are marked in the text, which is then cut at
    the marks (two characters of the private use area)."""
    return rf"""{kind}_cut as (
        select doc_id, string_split(regexp_replace(text, '{pattern}', chr(57344) || '\0' || chr(57345),
            'g'), chr(57344)) parts from {source}),
    {kind} as (
        select doc_id, split_part(parts[i], chr(57345), 1) hit,
            list_sum(list_transform(parts[1:i - 1], lambda x: length(x)))::bigint - (i - 2) start
        from {kind}_cut, unnest(range(2, len(parts) + 1)) u(i))"""


def _secrets() -> str:
    word = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in
                   "(password|passwd|secret|token|api_?key)")
    assign = word + r"""["\'']?\x20*[:=]\x20*["\'']?([A-Za-z0-9+/_.=-]+)""".replace("\\''", "''")
    classes = (("high_hex", "[0-9A-Fa-f]", 24, 3.0), ("high_base36", "[0-9a-z]", 20, 3.7),
               ("high_base64", "[A-Za-z0-9+/=_-]", 20, 3.9))
    allowed = "|".join(f"({p})" for p in (
        "[A-Za-z+/=_-]+", "[0-9]+([-/_][0-9]+)*",
        "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
        "[A-Za-z0-9+/=_-]*([Ee]xample|EXAMPLE|[Ss]ample|[Pp]laceholder)[A-Za-z0-9+/=_-]*",
        "[A-Za-z]*(abcdefghijklmnop|ABCDEFGHIJKLMNOP|0123456789)[A-Za-z0-9]*"))
    parts, spans = [], []
    for rank, (kind, chars, window, bits) in enumerate(classes, 3):
        parts.append(_runs(f"{kind}_run", "texts", f"{chars}{{{window},}}"))
        parts.append(f"""{kind}_marked as (
        select doc_id, start, i from (
            select doc_id, start, i, hit[j] c, count(*) n
            from (select * from {kind}_run where not regexp_full_match(hit, '{allowed}')),
                unnest(range(1, length(hit) - {window} + 2)) u(i),
                unnest(range(i, i + {window})) v(j)
            group by all)
        group by all having sum(round(n * log2(n) * 1048576))
            <= floor(({window} * log2({window}) - {window} * {bits}) * 1048576)),
    {kind} as (
        select doc_id, '{kind}' kind, {rank} as rk, start + min(i) - 1 start,
            start + max(i) - 1 + {window} stop
        from (select *, sum(opens) over (partition by doc_id, start order by i) no from (
            select *, case when i - lag(i) over (partition by doc_id, start order by i) <= {window}
                then 0 else 1 end opens from {kind}_marked))
        group by doc_id, start, no)""")
        spans.append(f"select * from {kind}")
    return rf"""
    with texts as (select doc_id, coalesce(text, '') as text from documents),
    {_runs('assign', 'texts', assign)}, {_runs('access', 'texts', 'AKIA[A-Z0-9]+')},
    {_runs('hex', 'texts', '[0-9a-f]+')}, {', '.join(parts)},
    base as (
        select doc_id, 'assign' kind, 0 as rk, start, start + length(hit) stop from assign
        where length(regexp_extract(hit, '{assign}', 2)) >= 8
        union all select doc_id, 'access', 1, start, start + length(hit) from access
        where length(hit) >= 16
        union all select doc_id, 'hex', 2, start, start + length(hit) from hex
        where length(hit) >= 32),
    every as (select * from base union all {' union all '.join(spans)}),
    listed as (
        select doc_id, count(*) filter (kind = 'assign') n_assign,
            count(*) filter (kind = 'access') n_access, count(*) filter (kind = 'hex') n_hex,
            string_agg(kind || ':' || start || ':' || stop, ',' order by start, rk)
                filter (rk < 3) base,
            string_agg(kind || ':' || start || ':' || stop, ',' order by start, rk) spans
        from every group by doc_id)
    select doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access,
        coalesce(n_hex, 0) n_hex, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
    from documents left join listed using (doc_id)"""


_COLLOCATIONS = r"""
    with pieces as (
        select coalesce(lang, 'und') lang, unnest(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) piece from documents),
    words as (
        select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') w
        from pieces),
    grams as (
        select lang, m, w[i:i + m - 1] g from words, unnest([1, 2, 3, 4]) s(m),
            unnest(range(1, len(w) - m + 2)) u(i)),
    f as materialized (select lang, m, g, count(*) f from grams group by all),
    totals as (select lang, sum(f)::bigint n from f where m = 1 group by lang),
    candidates as materialized (select * from f where m > 1 and f >= 30),
    parted as materialized (
        select lang, g, f a, k, g[1:k] first, g[k + 1:m] rest
        from candidates, unnest(range(1, m)) u(k)),
    cuts as (
        select p.lang, p.g, a, k, l.f l, r.f r,
            (2000000::hugeint * a // (l.f + r.f))::bigint score
        from parted p join f l on l.lang = p.lang and l.g = p.first
            join f r on r.lang = p.lang and r.g = p.rest),
    scored as (
        select lang, g, any_value(a) a, arg_min(l, (score, k)) l, arg_min(r, (score, k)) r,
            min(score) score from cuts group by lang, g),
    inside as (
        select lang, g[i:i + s - 1] g, max(f) around
        from candidates, unnest(range(2, m)) x(s), unnest(range(1, m - s + 2)) u(i) group by all),
    ranked as (
        select s.lang, array_to_string(s.g, ' ') phrase, a, l, r, n, score,
            row_number() over (partition by s.lang order by score desc, a desc,
                encode(array_to_string(s.g, ' '))) as rank
        from scored s left join inside i on i.lang = s.lang and i.g = s.g
            join totals t on t.lang = s.lang
        where coalesce(100 * around < 80 * a, true))
    select * from ranked where rank <= 2000"""

# crc32 is taken byte by byte with its table; two words are near if one less a code point is the other,
# or both less the code point of one place are equal.
_SPELLINGS = r"""
    with recursive bits(k, b, c) as (
        select 0, range, range from range(256)
        union all
        select k + 1, b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end
        from bits where k < 8),
    crc as (select list(c order by b) t from bits where k = 8),
    runs as (
        select coalesce(doc_id::varchar, '') id, translate(unnest(regexp_extract_all(
            coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') run from documents),
    counted as (select id, run, count(*) n from runs group by all),
    keyed as (select *, hex(encode(id || ':' || run)) h from counted),
    summed as (
        select run, n, xor(list_reduce(list_transform(range(0, length(h) // 2),
                lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint),
            lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1]), 4294967295), 4294967295) c
        from keyed, crc),
    dropped as (
        select case when c % 97 = 0 then substr(run, 1, (c % length(run))::bigint)
            || substr(run, (c % length(run))::bigint + 2) else run end word, n from summed),
    words as materialized (
        select word, sum(n)::bigint n, length(word) m from dropped where length(word) >= 5
        group by word having sum(n) >= 3),
    less as materialized (
        select word, n, m, i, substr(word, 1, i - 1) || substr(word, i + 1) rest
        from words, unnest(range(1, m + 1)) u(i)),
    pairs as (
        select a.word, a.n, b.word near, b.n near_n from less a join less b
            on a.m = b.m and a.i = b.i and a.rest = b.rest and a.word <> b.word
        union select w.word, w.n, l.word, l.n from words w join less l on l.rest = w.word
        union select l.word, l.n, w.word, w.n from words w join less l on l.rest = w.word),
    best as (
        select word, count(*) n_near, arg_min(near, (-near_n, encode(near))) near,
            max(near_n) near_n from pairs group by word),
    forms as materialized (
        select w.word, case when near_n >= 2 * n then near end form, n,
            coalesce(n_near, 0) n_near, case when near_n >= 2 * n then near_n end form_n
        from words w left join best using (word)),
    steps(word, here) as (
        select word, word from forms
        union all select s.word, f.form from steps s join forms f on f.word = s.here
        where f.form is not null),
    ends as (select s.word, arg_max(here, f.n) root from steps s join forms f on f.word = s.here
        group by s.word)
    select word, form, root, n, n_near, form_n from forms join ends using (word)"""

ORACLE = {"op1_quality_rules": _quality_rules(), "op2_url_filters": _URL_FILTERS,
          "op5_decontamination": _DECONTAMINATION, "op11_secret_scan": _secrets(),
          "op12_collocations": _COLLOCATIONS, "op13_spelling_groups": _SPELLINGS}
