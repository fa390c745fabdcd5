"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, read

SHARDS = 24


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html import main_text

    return main_text(read(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, toxicity

    docs, out = read(spark, sf_dir, "documents"), held_out("doc_id", 4, 2)
    model = fit(docs, read(spark, sf_dir, "labels"), "toxic", usable=~out)
    return toxicity(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import without_repeats

    found = without_repeats(read(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact import exact_duplicates

    return exact_duplicates(read(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import similar_components

    return similar_components(read(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import fit, identify

    docs = read(spark, sf_dir, "documents")
    out = held_out("doc_id", 5, 0)
    found = identify(docs, fit(docs.where(~out), "text", "lang"))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    return shard(read(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1))


#: Permitted sequence lengths, in characters.
SEQUENCE_LENGTHS = (1024, 2048, 4096, 8192, 16384)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import best_fit

    docs = read(spark, sf_dir, "documents")
    return best_fit(docs, F.char_length("text"), SEQUENCE_LENGTHS)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    names = F.array_join("items", ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), "contaminated")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file; TOKENIZER_DIR names another folder than the installed one."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokens import token_counts

    return token_counts(read(spark, sf_dir, "documents"), tokenizer_path())


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .audit import filter_audit

    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(read(spark, sf_dir, "embeddings"), 8)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode

    encoded = encode(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), decoded_col="decoded")
    names = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select("doc_id", "n_tokens", F.sha2(names, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_toxicity, op3_substring_dedup, op4_exact_dedup, op5_ngram_jaccard, op6_language_id, op7_sharding, op8_best_fit_packing, op9_decontamination, op10_token_counts, op11_filter_audit, op12_embedding_whitening, op13_byte_bpe)}

SQL = {
    "op4_exact_dedup": r"""
        with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as v from documents)
        select doc_id, min(doc_id) over (partition by v) as keep_id, count(*) over (partition by v) as group_size,
               doc_id = min(doc_id) over (partition by v) as kept, sha256(v) as text_sha256
        from t""",
    "op3_substring_dedup": r"""
        with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
        p as (select doc_id, words, unnest(range(1, len(words) - 33)) as i from w where len(words) >= 35),
        g as (select doc_id, i, array_to_string(words[i:i + 34], ' ') as win from p),
        r as (select doc_id, i from (select doc_id, i, count(*) over (partition by win) as n from g) where n > 1),
        gone as (select distinct doc_id, i + o as at from r, (select unnest(range(0, 35)) as o)),
        each as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as at from w),
        kept as (select e.doc_id, count(*) as n_words, count(g.at) as n_removed, string_agg(e.word, ' ' order by e.at) filter (where g.at is null) as text from each e left join gone g on e.doc_id = g.doc_id and e.at = g.at group by e.doc_id)
        select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(k.text, '')) as kept_sha256 from documents d left join kept k on d.doc_id = k.doc_id""",
    "op5_ngram_jaccard": r"""
        with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
        s as materialized (select distinct doc_id, array_to_string(words[i:i + 2], ' ') as g from (select doc_id, words, unnest(range(1, greatest(2, len(words) - 1))) as i from w where len(words) > 0)),
        n as materialized (select doc_id, count(*) as size from s group by doc_id),
        c as (select a.doc_id as x, b.doc_id as y, count(*) as shared from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
        l as materialized (select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where 100 * shared >= 90 * (p.size + q.size - shared)),
        e as materialized (select x, y from l union all select y, x from l),
        r(doc_id, other) as (select doc_id, doc_id from documents union select r.doc_id, e.y from r join e on r.other = e.x)
        select d.doc_id, coalesce(n.size, 0) as n_shingles, m.component_id from documents d left join n on n.doc_id = d.doc_id join (select doc_id, min(other) as component_id from r group by doc_id) m on m.doc_id = d.doc_id""",
    "op9_decontamination": r"""
        with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
        b as (select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
        bw as (select distinct item, n, array_to_string(words[i:i + n - 1], ' ') as win from (select item, words, least(10, len(words)) as n, unnest(range(1, len(words) - least(10, len(words)) + 2)) as i from b where len(words) > 0)),
        dw as (select doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') as win from (select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as i from d, (select distinct n from bw) where len(words) >= n)),
        hit as (select doc_id, dw.n, i, item from dw join bw on dw.n = bw.n and dw.win = bw.win),
        words_hit as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(i, i + n)) as at from (select distinct doc_id, n, i from hit)) group by doc_id),
        items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct doc_id, item from hit) group by doc_id)
        select d.doc_id, cast(len(d.words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join words_hit h on d.doc_id = h.doc_id left join items i on d.doc_id = i.doc_id""",
    "op11_filter_audit": r"""
        with t as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
        f as (select doc_id, part, len(words) < 100 as a, 100 * len(list_distinct(words)) < 80 * len(words) as b, 100 * len(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * len(text) as c,
                     regexp_matches(text, '[#$%&*|]') as d, coalesce(doc_id > min(doc_id) over (partition by text), false) as e from t),
        l as (select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic from labels group by doc_id),
        h as (select part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int as mask, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic
              from f left join l on f.doc_id = l.doc_id group by 1, 2),
        x as (select unnest(['A', 'B', 'C', 'D', 'E']) as letter, unnest([1, 2, 4, 8, 16]) as bit),
        o as (select p.letter || q.letter || r.letter || s.letter || t.letter as filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] as bits from x p, x q, x r, x s, x t where p.bit + q.bit + r.bit + s.bit + t.bit = 31 and p.bit | q.bit | r.bit | s.bit | t.bit = 31),
        g as (select filter_order, step, bits[step] as bit, list_sum(bits[1:step - 1])::int as earlier from o, (select unnest(range(1, 6)) as step)),
        m as (select g.*, part, h.mask, n, good, toxic, h.mask & bit > 0 as fails, coalesce(h.mask & earlier, 0) > 0 as gone from g, h),
        r as (select part, filter_order, step, bit, coalesce(sum(n) filter (where not fails and not gone), 0)::bigint as kept, coalesce(sum(n) filter (where fails and not gone), 0)::bigint as removed,
                     coalesce(sum(n) filter (where fails and gone), 0)::bigint as redundant, coalesce(sum(n) filter (where mask = bit), 0)::bigint as unique_fails,
                     coalesce(sum(good) filter (where fails and not gone), 0)::bigint as good_lost, coalesce(sum(toxic) filter (where fails and not gone), 0)::bigint as toxic_lost from m group by 1, 2, 3, 4)
        select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) over (partition by part, bit))::bigint as shapley from r""",
}
