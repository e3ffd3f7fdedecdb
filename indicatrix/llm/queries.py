"""The operators applied to whole tables, each with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import build_index, search_index
from . import quality
from .common import crc_remainder
from .exact_dedup import exact_groups
from .katz import katz_scores
from .language_id import identify, train
from .line_dedup import apply_bitmaps, line_bitmaps
from .mixing import mix
from .near_join import near_classes
from .packing import pack_documents
from .phrases import collocations
from .token_ids import packed_documents
from .whitening import whiten
from .wrappers import page_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "labels").where("quality is not null")
            .select("doc_id", F.when(F.col("quality") == 1, 2.0).otherwise(0.5).alias("weight")))


def vocabulary(name: str) -> str:
    """A public vocabulary file, from the package that keeps them outside the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(r"""
    with quality as (
      select doc_id quality_id, max(case when quality = 1 then 2.0 else 0.5 end)::double w from labels
      where quality is not null group by doc_id),
    rows as (
      select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint size,
             coalesce(w, 1.0) w,
             (('0x' || substr(md5('0|' || coalesce(doc_id::varchar, '')), 1, 12))::bigint + 0.5) / 281474976710656.0::double u
      from documents left join quality on doc_id = quality_id),
    sizes as (
      select source, sum(size)::double source_size,
             [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double weight
      from rows group by source),
    ranked as (
      select *, source_size * 2.0 cap, source_size * 2.0 / weight fill, sum(source_size) over () * 1.5 budget,
             sum(source_size * 2.0) over f - source_size * 2.0 capped, sum(weight) over () - sum(weight) over f + weight open
      from sizes window f as (order by source_size * 2.0 / weight, source nulls last)),
    levels as (
      select *, (min(case when (budget - capped) / open < fill then {'f': fill, 'x': (budget - capped) / open} end)
                 over ()).x as lev from ranked),
    targets as (
      select source, source_size, case when lev is null or fill <= lev then cap else lev * weight end target from levels),
    budgets as (
      select *, coalesce(case when source_size > 0 then floor(target / source_size) end, 0)::bigint epochs from targets),
    keyed as (
      select r.doc_id, r.size, b.*, b.target - b.epochs * b.source_size rest,
             sum(r.size) over (partition by r.source order by -ln(u) / w, r.doc_id, r.size
                               rows between unbounded preceding and current row) until
      from rows r join budgets b on r.source is not distinct from b.source)
    select doc_id, size, source_size::bigint source_size, target,
           (size * (epochs + case when until - size / 2.0 <= rest then 1 else 0 end))::bigint taken
    from keyed""")
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled good are drawn four times as readily as those labelled bad."""
    mixed = mix(table(spark, sf_dir, "documents"), quality_weights(spark, sf_dir))
    return mixed.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target",
                        F.col("taken").cast("long").alias("taken"))


@query(r"""
    with lines as (
      select doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) pos, row_number() over () r
      from documents),
    keyed as (
      select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k
      from lines),
    common as (
      select k from keyed where length(k) >= 1 group by k having count(distinct coalesce(doc_id::varchar, 'null')) >= 10),
    marked as (select keyed.*, k in (select k from common) gone from keyed)
    select any_value(doc_id) doc_id, count(*)::bigint n_lines, count(*) filter (gone)::bigint n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) kept_sha256
    from marked group by r""")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = apply_bitmaps(docs, line_bitmaps(docs))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("""
    with rows as (select doc_id, sha256(coalesce(text, '')) text_sha256 from documents),
    groups as (select text_sha256 g, max(doc_id) keep_id, count(*)::bigint group_size from rows group by 1)
    select doc_id, keep_id, group_size, doc_id = keep_id kept, text_sha256 from rows join groups on g = text_sha256""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@query()
def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query()
def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query()
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search_index(build_index(vectors), vectors.where("vec_id % 20 = 0"))


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pieces = table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")
    held_out = crc_remainder(F.col("doc_id"), 4) == 2
    langs, model = train(docs.where(~held_out).select("lang", "text"), pieces)
    return identify(docs, langs, model, pieces, keep={"doc_id": F.col("doc_id"), "held_out": held_out})


@query()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_remainder(F.col("doc_id"), 5) == 0
    labels = (table(spark, sf_dir, "labels").where(crc_remainder(F.col("doc_id"), 5) != 0)
              .select("doc_id", F.col("quality").alias("label")))
    model = quality.train(docs.where(~held_out), labels)
    return quality.score(docs, model, keep={"doc_id": F.col("doc_id"), "held_out": held_out})


@query()
def op7_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query()
def op4_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_remainder(F.col("doc_id"), 10) == 0
    scores = katz_scores(table(spark, sf_dir, "documents"), held_out, order=3)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query(r"""
    with docs as (
      select coalesce(lang, 'und') lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
    pieces as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) p from docs),
    words as (select lang, regexp_extract_all(p, '[^\x20\x09]+') ws from pieces),
    totals as (select lang, sum(len(ws))::bigint n from words group by lang),
    grams as (
      select lang, unnest(flatten(list_transform(range(1, 5), lambda k: list_transform(
               range(1, len(ws) - k + 2), lambda i: list_slice(ws, i, i + k - 1))))) g from words),
    f as (select lang, g, count(*)::hugeint a from grams group by lang, g having count(*) >= 30),
    candidates as (select * from f where len(g) >= 2),
    cuts as (
      select c.*, x.a l, y.a r, (2000000 * c.a) // (x.a + y.a) score
      from (select *, unnest(range(1, len(g))) k from candidates) c
      join f x on x.lang = c.lang and x.g = list_slice(c.g, 1, c.k)
      join f y on y.lang = c.lang and y.g = list_slice(c.g, c.k + 1, len(c.g))),
    best as (select * from cuts qualify row_number() over (partition by lang, g order by score, k) = 1),
    inside as (
      select lang, s, max(a) most from (
        select lang, a, unnest(flatten(list_transform(range(2, len(g)), lambda k: list_transform(
                 range(1, len(g) - k + 2), lambda i: list_slice(g, i, i + k - 1))))) s from candidates) group by lang, s),
    kept as (
      select b.lang, array_to_string(b.g, ' ') phrase, b.a, b.l, b.r, b.score
      from best b left join inside i on i.lang = b.lang and i.s = b.g where i.most is null or 100 * i.most < 80 * b.a)
    select kept.lang, row_number() over (partition by kept.lang order by score desc, a desc, phrase)::bigint rank, phrase,
           a::bigint a, l::bigint l, r::bigint r, n, score::bigint score
    from kept join totals on totals.lang = kept.lang qualify rank <= 2000""")
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query(r"""
    with articles as (
      select page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(?:</article>|$)', 1, 's') a from pages),
    texts as (
      select page_id, url, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(
               regexp_replace(regexp_replace(a, '</?(?:p|h1|br)>', ' ', 'g'), '</?b>', '', 'g'),
               '&copy;', '©'), '&middot;', '·'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g'),
               '[\s\x{85}\p{Z}]+', ' ', 'g')) text from articles)
    select page_id, url, text, length(text)::bigint n_chars from texts""")
def op12_page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL is right for pages like the given ones, whose text is one article element without parts to leave out."""
    return page_texts(table(spark, sf_dir, "pages"))


@query()
def op11_whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
