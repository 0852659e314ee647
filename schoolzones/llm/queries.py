"""The queries over the driver's tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format,
    decontaminate,
    filter_audit,
    html_text,
    license_scan,
    mixing,
    quality_rules,
    resampling,
    simhash_dedup,
    substring_dedup,
    surrogates,
    token_files,
    warc,
)
from .store import new_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer() -> str:
    """The vocabulary file of the token files, where the driver has it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents"))


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    done = chat_format.format_conversations(rows)
    read = done.select(
        "conv_id",
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat_format.read_loss(F.col("formatted"), F.col("loss")), "").alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return simhash_dedup.components(docs).select("doc_id", "fingerprint", "component_id")


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.encoded(table(spark, folder, "documents"), tokenizer())


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    place = F.concat_ws("/", F.lit("corpus"), "source", "lang", F.expr("doc_id div 100").cast("string"), F.col("doc_id").cast("string"))
    files = table(spark, folder, "documents").select(place.alias("path"), "text")
    doc_id = F.element_at(F.split("path", "/"), -1).cast("long").alias("doc_id")
    found = license_scan.scan(files).withColumn("cosine", F.round("cosine", 6))
    return found.select(doc_id, "path", "license", "cosine", "origin", "directory")


def _licenses_sql() -> str:
    """The same definition in SQL; here all files lie in directories of one depth, so one step up is enough."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    templates = ", ".join(f"({i}, {quoted(name)}, {quoted(text)})" for i, (name, text) in enumerate(license_scan.TEMPLATES))
    cue, term = quoted(license_scan._CUE), quoted(license_scan._TERM)
    return f"""
        with files as (
            select doc_id, concat_ws('/', 'corpus', source, lang, doc_id // 100, doc_id) as path,
                coalesce(text, '') as text from documents
        ),
        said as (
            select doc_id, path, n_words, part, regexp_extract_all(lower(part), {term}) as terms from (
                select doc_id, path, len(regexp_split_to_array(trim(text), '[\\x20\\x09-\\x0D]+')) as n_words,
                    unnest(string_split(regexp_replace(text, '([.!?])[ \\t]+(\\p{{Lu}})', '\\1' || chr(10) || '\\2', 'g'), chr(10))) as part
                from files
            ) where regexp_matches(part, {cue})
        ),
        templates(template, license, text) as (values {templates}),
        known as (select template, license, regexp_extract_all(lower(text), {term}) as terms from templates),
        total as (select (select count(*) from said) + (select count(*) from known) as n),
        seen as (
            select term, count(*) as df from (
                select unnest(list_distinct(terms)) as term from said
                union all select unnest(list_distinct(terms)) from known
            ) group by 1
        ),
        idf as (select term, ln((1 + n) / (1 + df)) + 1 as idf from seen, total),
        vectors as (
            select id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) over (partition by id)) as w from (
                select id, term, count(*) as tf from (
                    select part as id, unnest(terms) as term from (select distinct part, terms from said)
                    union all select '#' || template, unnest(terms) from known
                ) group by 1, 2
            ) join idf using (term)
        ),
        close as (
            select a.id as part, b.id as template, round(sum(a.w * b.w), 9) as cosine
            from vectors a join vectors b using (term)
            where b.id in (select '#' || template from known) and a.id not in (select '#' || template from known)
            group by 1, 2 having round(sum(a.w * b.w), 9) >= {license_scan.MIN_COSINE}
        ),
        own as (
            select doc_id, path, arg_min(license, (-cosine, license)) as license, max(cosine) as cosine,
                max(len(said.terms) / n_words) as share
            from said join close using (part) join known k on '#' || k.template = close.template group by 1, 2
        ),
        home as (
            select regexp_replace(path, '/[^/]*$', '') as directory, arg_min(license, path) as license2,
                arg_min(cosine, path) as cosine2
            from own where share >= 0.5 group by 1
        )
        select f.doc_id, f.path, coalesce(license, license2) as license, round(coalesce(cosine, cosine2), 6) as cosine,
            case when license is not null then 'own' when license2 is not null then 'inherited' end as origin,
            case when license is null and license2 is not null then directory end as directory
        from files f left join own using (doc_id) left join home on home.directory = regexp_replace(f.path, '/[^/]*$', '')"""


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _leaks_sql() -> str:
    """The same definition in SQL, over all pairs of windows with equal templates."""
    token, size = decontaminate._TOKEN.replace("'", "''"), decontaminate.WINDOW
    units = ", ".join(f"'{u}'" for u in decontaminate.UNITS)
    number, unit, name = (f"chr({i})" for i in (1, 2, 3))
    slot = f"in ({number}, {unit}, {name})"

    def texts(table: str, key: str) -> str:
        return f"""
            select key, raw, list_transform(raw, lambda x, i: case
                when x >= '0' and x < ':' then {number}
                when rtrim(x, '.!?') <> lower(rtrim(x, '.!?')) and length(rtrim(x, '.!?')) > 1
                    and rtrim(x, '.!?')[2:] = lower(rtrim(x, '.!?'))[2:]
                    and i > 1 and right(raw[i - 1], 1) not in ('.', '!', '?') then {name}
                when i > 1 and raw[i - 1] >= '0' and raw[i - 1] < ':' and lower(rtrim(x, '.!?')) in ({units}) then {unit}
                else lower(rtrim(x, '.!?')) end) as keys
            from (select {key} as key, regexp_extract_all(coalesce(text, ''), '{token}') as raw from {table})"""

    def windows(table: str) -> str:
        return f"""
            select key, raw, pos, n_slots, array_to_string(case when n_slots > {decontaminate.MAX_PLACEHOLDERS}
                then list_transform(raw[pos + 1 : pos + {size}], lambda x: lower(rtrim(x, '.!?')))
                else keys[pos + 1 : pos + {size}] end, ' ') as t
            from (
                select *, len(list_filter(keys[pos + 1 : pos + {size}], lambda x: x {slot})) as n_slots
                from (select *, unnest(range(0, len(keys) - {size - 1})) as pos from {table} where len(keys) >= {size})
            )"""

    return f"""
        with items as ({texts('benchmark', 'item_id')}),
        docs as ({texts('documents', 'doc_id')}),
        wanted as (
            select key as item, t, min(pos) as wpos
            from (select *, min(n_slots) over (partition by key, raw) as least from ({windows('items')}))
            where n_slots <= {decontaminate.MAX_PLACEHOLDERS} or least > {decontaminate.MAX_PLACEHOLDERS} group by 1, 2
        ),
        sizes as (select item, count(*) as n_windows from wanted group by 1),
        met as (select key as doc, item, t, pos - wpos as shift from ({windows('docs')}) join wanted using (t)),
        enough as (
            select doc, item, count(distinct t) as n_matched, n_windows from met join sizes using (item)
            group by doc, item, n_windows having count(distinct t) >= {decontaminate.MIN_SHARE} * n_windows
        ),
        best as (
            select doc, item, arg_max(shift, (n, -shift)) as shift
            from (select doc, item, shift, count(distinct t) as n from met group by 1, 2, 3) group by 1, 2
        ),
        slots as (
            select doc, item, kind, lower(rtrim(a, '.!?')) as a, lower(rtrim(b, '.!?')) as b from (
                select doc, item, i.keys[p] as kind, i.raw[p] as a, d.keys[p + shift] as other, d.raw[p + shift] as b
                from (select *, unnest(range(1, 1 + (select max(len(keys)) from items))) as p from best)
                join items i on i.key = item join docs d on d.key = doc
                where p + shift between 1 and len(d.keys)
            ) where kind {slot} and kind = other
        ),
        renamed as (
            select doc, item, count(*) as n_slots, count(distinct (kind, a, b)) as pairs,
                count(distinct (kind, a)) as n_a, count(distinct (kind, b)) as n_b
            from slots group by 1, 2
        )
        select doc as doc_id, item as item_id, n_windows, n_matched, cast(coalesce(n_slots, 0) as bigint) as n_slots
        from enough left join renamed using (doc, item)
        where n_slots is null or (pairs = n_a and pairs = n_b)"""


#: The key of the surrogates; a release of data takes its own.
SURROGATE_KEY = "a key for each release"


def op9_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.pseudonymized(table(spark, folder, "documents"), SURROGATE_KEY)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules.verdicts(docs, name="q").select(
        "doc_id",
        *(f"q.{x}" for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        *(f"q.{x}" for x in ("base_failed", "kept", "line_chars", "dup_line_chars")),
        *(
            F.col("q.ngram_chars")[i].alias(f"chars_in_repeated_{n}_grams")
            for i, n in enumerate(quality_rules.Rules().lengths)
        ),
    )


def _quality_sql() -> str:
    rules = quality_rules.Rules()
    covered = "".join(
        f"""
        repeated_{n} as (
            select doc_id, sum(length(word)) as chars, count(*) as words
            from each semi join (
                select distinct doc_id, unnest(range(s, s + {n})) as i from (
                    select doc_id, s from (
                        select doc_id, ws, unnest(range(1, len(ws) - {n - 2})) as s from w where len(ws) >= {n}
                    ) qualify count(*) over (partition by doc_id, array_to_string(ws[s : s + {n - 1}], ' ')) > 1
                )
            ) using (doc_id, i) group by doc_id
        ),"""
        for n in rules.lengths
    )
    joins = " ".join(
        f"left join (select doc_id, chars as chars_{n}, words as words_{n} from repeated_{n}) using (doc_id)"
        for n in rules.lengths
    )
    long = lambda x: f"cast(coalesce({x}, 0) as bigint)"
    grams = ", ".join(f"{long(f'chars_{n}')} as chars_in_repeated_{n}_grams" for n in rules.lengths)
    too_much = " or ".join(
        f"chars_in_repeated_{n}_grams > {share!r}::double * word_chars"
        for n, share in zip(rules.lengths, rules.max_ngram_share)
    )
    return f"""
        with w as (select doc_id, coalesce(text, '') as text, {_WORDS} as ws from documents),
        each as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from w),{covered}
        lines as (
            select doc_id, sum(length(line)) as line_chars, count(*) filter (k > 1) as n_dup,
                sum(length(line)) filter (k > 1) as dup_chars
            from (
                select doc_id, line, row_number() over (partition by doc_id, line) as k
                from (select doc_id, unnest(string_split(text, chr(10))) as line from w)
                where regexp_matches(line, '[^\\x20\\x09-\\x0D]')
            ) group by doc_id
        ),
        measured as (
            select doc_id, cast(len(ws) as bigint) as n_words,
                {long("list_sum(list_transform(ws, lambda x: length(x)))")} as word_chars,
                cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
                {long("n_dup")} as n_dup_lines, {long(f"words_{rules.window}")} as n_repeat_words,
                {long("line_chars")} as line_chars, {long("dup_chars")} as dup_line_chars, {grams}
            from w left join lines using (doc_id) {joins}
        )
        select *, base_failed = false and not (
            dup_line_chars > {rules.max_line_share!r}::double * line_chars or {too_much}) as kept
        from (
            select *, n_words < {rules.min_words} or 100 * n_repeat_words > {rules.max_repeat_pct} * n_words as base_failed
            from measured)"""


def op11_warc_salvage(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write(table(spark, folder, "pages"), path)
    read = warc.records(warc.read(spark, path, with_payload=False))
    return read.select(
        warc.key_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        warc.key_of("refers_to").alias("refers_to"),
    )


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("words", filter_audit.words_of(F.col("text")))
    filters = filter_audit.standard_filters(F.col("text"), F.col("words"))
    return filter_audit.audit(docs, table(spark, folder, "labels"), filters, copies="E")


def _audit_sql() -> str:
    """The same definition in SQL, over every order and row."""
    letters = "['A', 'B', 'C', 'D', 'E']"
    return f"""
        with docs as (
            select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, {_WORDS} as ws,
                min(doc_id) over (partition by coalesce(text, '')) as least
            from documents
        ),
        tagged as (
            select doc_id, max(cast(quality = 1 as int)) as good, max(cast(toxic = 1 as int)) as toxic
            from labels group by doc_id
        ),
        failing as (
            select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, list_filter([
                case when len(ws) < 100 then 'A' end,
                case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 'B' end,
                case when 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) then 'C' end,
                case when regexp_matches(text, '[#$%&*|]') then 'D' end,
                case when doc_id > least then 'E' end
            ], lambda x: x is not null) as fails
            from docs left join tagged using (doc_id)
        ),
        orders as (
            select a || b || c || d || e as filter_order
            from (select unnest({letters}) as a), (select unnest({letters}) as b), (select unnest({letters}) as c),
                (select unnest({letters}) as d), (select unnest({letters}) as e)
            where len(list_distinct([a, b, c, d, e])) = 5
        ),
        steps as (
            select filter_order, cast(step as int) as step, filter_order[step] as f, string_split(filter_order[1 : step - 1], '') as earlier
            from (select *, unnest(range(1, 6)) as step from orders)
        ),
        kinds as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from failing group by all),
        each as (
            select part, filter_order, step, f, list_contains(fails, f) as hit,
                len(list_intersect(fails, earlier)) > 0 as gone, len(fails) as n_fails, n, good, toxic
            from kinds, steps
        ),
        counts as (
            select part, filter_order, step, f,
                coalesce(sum(n) filter (not gone and not hit), 0) as kept,
                coalesce(sum(n) filter (hit and not gone), 0) as removed,
                coalesce(sum(n) filter (hit and gone), 0) as redundant,
                coalesce(sum(n) filter (hit and n_fails = 1), 0) as unique_fails,
                coalesce(sum(good) filter (hit and not gone), 0) as good_lost,
                coalesce(sum(toxic) filter (hit and not gone), 0) as toxic_lost
            from each group by all
        )
        select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
            unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
            (sum(removed) over (partition by part, f))::bigint as shapley
        from counts"""


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs, target = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return resampling.resample(docs, target).drop("n_words")


def _resampling_sql() -> str:
    """The same definition in SQL; CRC-32 byte by byte, over the distinct words."""
    spec = resampling.Spec()
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    step = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    return f"""
        with recursive bits as (
            select i as byte, i::bigint as c, 0 as k from range(256) t(i)
            union all select byte, {step}, k + 1 from bits where k < 8
        ),
        bytes as (select byte, c from bits where k = 8),
        docs as (select doc_id, regexp_extract_all({lower}, '{word}') as ws from documents),
        items as (select regexp_extract_all({lower}, '{word}') as ws from benchmark),
        in_docs as (select doc_id, unnest(ws) as word from docs),
        in_items as (select unnest(ws) as word from items),
        words as (
            select word, hex(encode(word)) as h from (select word from in_docs union select word from in_items)
        ),
        crc as (
            select word, h, 4294967295::bigint as c, 0 as k from words
            union all
            select word, h, xor(crc.c >> 8, bytes.c), k + 1
            from crc join bytes on bytes.byte = xor(crc.c & 255, ('0x' || h[2 * k + 1 : 2 * k + 2])::bigint)
            where 2 * k < length(h)
        ),
        bucket_of as (select word, xor(c, 4294967295) % {spec.buckets} as bucket from crc where 2 * k = length(h)),
        s as (select bucket, count(*) as s from in_docs join bucket_of using (word) group by 1),
        t as (select bucket, count(*) as t from in_items join bucket_of using (word) group by 1),
        totals as (select (select coalesce(sum(s), 0) from s) as ss, (select coalesce(sum(t), 0) from t) as tt),
        gain as (
            select b.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * (ss + {spec.buckets})::double
                / ((coalesce(s, 0) + 1)::double * (tt + {spec.buckets})::double)))::bigint as gain
            from range({spec.buckets}) b(bucket) left join s using (bucket) left join t using (bucket), totals
        ),
        weights as (
            select doc_id, count(*) as n, floor(sum(gain) / count(*))::bigint as weight
            from in_docs join bucket_of using (word) join gain using (bucket) group by 1
        ),
        scored as (
            select doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
                coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln(
                    (('0x' || sha256('{spec.key}:' || doc_id)[1:8])::bigint + 0.5)::double / 4294967296::double)))::bigint as score
            from docs left join weights using (doc_id)
        ),
        ranked as (
            select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n
            from scored where n_features >= {spec.min_words}
        )
        select doc_id, n_features, weight, score, rank
        from scored left join (select doc_id, rank from ranked where rank <= floor({spec.percent} * n / 100)) using (doc_id)"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_source_mixing,
        op3_chat_formatting,
        op4_simhash_near_dedup,
        op5_token_files,
        op6_license_scan,
        op7_html_extraction,
        op8_decontamination,
        op9_pii_surrogates,
        op10_quality_rules,
        op11_warc_salvage,
        op12_filter_audit,
        op13_importance_resampling,
    )
}
#: Equal rows in SQL. The other operators are closures, coders, tree matches or keyed draws: see tests/llm.
_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

ORACLE: dict[str, str] = {
    "op1_substring_dedup": f"""
        with w as (select doc_id, {_WORDS} as ws from documents),
        starts as (select doc_id, ws, unnest(range(1, len(ws) - 48)) as s from w where len(ws) >= 50),
        windows as (select doc_id, s, md5(array_to_string(ws[s : s + 49], ' ')) as h from starts),
        first as (select h, min(doc_id) as least from windows group by h),
        gone as (
            select distinct doc_id, unnest(range(s, s + 50)) as i
            from windows join first using (h) where doc_id > least
        ),
        each as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from w),
        kept as (
            select doc_id, count(*) as n, string_agg(word, ' ' order by i) as rest
            from each anti join gone using (doc_id, i) group by doc_id
        )
        select doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n, 0) as bigint) as n_removed,
            sha256(coalesce(rest, '')) as kept_sha256
        from w left join kept using (doc_id)""",
    "op3_chat_formatting": f"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ),
        sized as (
            select *, length(role) + length(text) + {len(chat_format.START + chat_format.END) + 2}
                + {' + '.join(
                    f"(length({c}) - length(replace({c}, '{mark}', ''))) // {len(mark)}"
                    for mark in ["\\", *chat_format.CONTROL] for c in ("role", "text")
                )} as chars
            from turns
        )
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
            cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), ''))
                as loss_sha256,
            cast(sum(chars) as bigint) as formatted_chars
        from sized group by conv_id""",
    "op6_license_scan": _licenses_sql(),
    "op8_decontamination": _leaks_sql(),
    "op10_quality_rules": _quality_sql(),
    "op11_warc_salvage": """
        with p as (
            select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as digest,
                min(page_id) over (partition by coalesce(html, '')) as least
            from pages
        )
        select page_id, n::bigint as payload_bytes, digest as payload_digest,
            case when n >= 100 and least < page_id then 'revisit' else 'response' end as record_type,
            case when n >= 100 and least < page_id then least end as refers_to
        from p""",
    "op12_filter_audit": _audit_sql(),
    "op13_importance_resampling": _resampling_sql(),
}
