"""The operators applied to the given tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm import chat, chroma, decontam, divergence, langid, minhash, mixing, periodic, pitman_yor, sharding, token_counts, url_lists, warc
from pulseframe.llm.rows import numbered_rows
from pulseframe.llm.text import WORD, id_remainder
from pulseframe.sources import staging

SHARDS = 40
TOKEN_LIMIT = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, draws = mixing.mix_sources(table(spark, sf_dir, "documents"))
    taken = draws.groupBy("row").agg(F.sum("size").alias("taken"), F.min("before").alias("first_drawn_at"))
    return rows.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_drawn_at")


def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", id_remainder(F.col("doc_id"), 3) == 1)
    model = langid.fit(docs.where("not held_out"))
    return langid.predict(docs.select("doc_id", "text", "held_out"), model).drop("text")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = pitman_yor.score_documents(table(spark, sf_dir, "documents"), id_remainder(F.col("doc_id"), 7) == 2)
    return scored.withColumn("held_out", id_remainder(F.col("doc_id"), 7) == 2)


def op6_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def vector_recordings(embeddings: DataFrame) -> DataFrame:
    """A recording (rec_id, audio as WAV) of each vector, since no table has audio.

    Two coordinates at a time sound as a chord of 0.2 s, low and high; a coordinate's note
    is its quarter among coordinates. Every recording begins with up to four hops of silence.
    One in a hundred (vec_id % 100 = 50) goes on to replay, more softly, the tune of the
    vector 50 before it, so recordings of unlike vectors have stretches in common too.
    """
    known = embeddings.where("vec_id is not null").select(F.col("vec_id").cast("long"), "embedding")
    tunes = known.where("vec_id % 100 = 0").groupBy((F.col("vec_id") + 50).alias("vec_id")).agg(F.min("embedding").alias("replayed"))

    def play(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        beat = chroma.RATE // 5
        t = np.arange(beat) / chroma.RATE
        notes = np.sin(2 * np.pi * t * 220 * 2 ** (np.arange(24)[:, None] / 12)) * np.hanning(beat)

        def tune(v: np.ndarray | None, loudness: float) -> np.ndarray:
            v = np.asarray(v if v is not None else [], dtype=np.float64)
            v = np.nan_to_num(v[: len(v) // 2 * 2])
            step = np.searchsorted([-0.084, 0.0, 0.084], v) * 3  # quartiles of a coordinate of a random unit vector of 64
            return loudness * (notes[step[0::2]] + notes[12 + step[1::2]]).ravel()

        # a few recordings at a time: their samples are many times their vectors
        for b in (b.iloc[k : k + 256] for b in batches for k in range(0, len(b), 256)):
            audio = []
            for i, v, r in zip(b["vec_id"], b["embedding"], b["replayed"], strict=True):
                pcm = np.concatenate([np.zeros(int(i) % 5 * chroma.HOP), tune(v, 12000), tune(r, 8000)]).astype("<i2")
                with io.BytesIO() as f:
                    with wave.open(f, "wb") as w:
                        w.setnchannels(1)
                        w.setsampwidth(2)
                        w.setframerate(chroma.RATE)
                        w.writeframes(pcm.tobytes())
                    audio.append(f.getvalue())
            yield pd.DataFrame({"rec_id": b["vec_id"], "audio": audio})

    return known.join(tunes, "vec_id", "left").mapInPandas(play, "rec_id long, audio binary")


def op7_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches: every recording whose id is divisible by 100, against all."""
    return chroma.match_recordings(vector_recordings(table(spark, sf_dir, "embeddings")), F.col("rec_id") % 100 == 0)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(
        table(spark, sf_dir, "documents"),
        tokenizer_path("word_bpe_49k.json"),
        staging.new_folder(spark, "token-cache"),
        token_counts.collapse_white_space,
        token_counts.count_pieces,
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_conversations(table(spark, sf_dir, "conversations"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages with a day of fetching, which the table lacks: spread over 2024 by page_id."""
    return pages.select("page_id", "url", F.expr("date_add(date'2024-01-01', cast((page_id * 7) % 360 as int))").alias("fetched_on"))


def host_entries(pages: DataFrame) -> DataFrame:
    """Three dated lists drawn from the pages' hosts: hosts, their parent domains, folders."""
    hosts = pages.where("url is not null and page_id is not null").select("page_id", url_lists.url_host(F.col("url")).alias("host"), F.regexp_extract("url", url_lists.FIRST_FOLDER, 1).alias("folder")).where("host <> ''")
    day = lambda e: F.expr(f"date_add(date'2024-01-01', cast({e} as int))")

    def entries(name: str, patterns: DataFrame, step: int, kinds: list[tuple[int, str]]) -> list[DataFrame]:
        first = patterns.groupBy("pattern").agg(F.min("page_id").alias("p"))
        return [first.select(F.lit(name).alias("list_name"), "pattern", day(f"(p * {step}) % 300 + {after}").alias("dated"), F.expr(action).alias("action")) for after, action in kinds]

    parents = hosts.select("page_id", F.expr("substring_index(host, '.', -2)").alias("pattern"))
    parts = [
        *entries("hosts", hosts.select("page_id", F.col("host").alias("pattern")), 13, [(0, "if(p % 3 = 0, 'allow', 'block')"), (45, "'remove'"), (120, "'block'")]),
        *entries("domains", parents, 29, [(0, "'block'"), (60, "'allow'"), (90, "'remove'")]),
        *entries("folders", hosts.where("folder <> ''").select("page_id", F.expr("host || folder").alias("pattern")), 17, [(0, "if(p % 2 = 0, 'allow', 'block')"), (30, "'remove'")]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op10_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_lists.filter_captures(page_captures(pages), host_entries(pages))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page into archives, and what reading them back gives: of a response from its payload, of a revisit from its header."""
    pages, row = numbered_rows(table(spark, sf_dir, "pages"), "pages", stored=True)
    captures = pages.select(F.col("page_id").alias("id"), "url", F.col("html").cast("binary").alias("payload"), row)
    folder = staging.new_folder(spark, "archives")
    warc.write_archives(warc.mark_revisits(captures, row), folder)
    records = warc.read_archives(spark, folder, {"bytes": lambda p: F.octet_length(p).cast("long"), "digest": F.sha1})
    kind = warc.header("WARC-Type")
    stored = kind == "response"
    return records.select(
        warc.captured_id(warc.header("WARC-Record-ID")).alias("page_id"),
        F.when(stored, F.col("bytes")).otherwise(warc.header("Payload-Length").cast("long")).alias("payload_bytes"),
        F.when(stored, F.col("digest")).otherwise(F.substring_index(warc.header("WARC-Payload-Digest"), "sha1:", -1)).alias("payload_digest"),
        kind.alias("record_type"),
        warc.captured_id(warc.header("WARC-Refers-To")).alias("refers_to"),
    )


def replayed_documents(docs: DataFrame) -> DataFrame:
    """doc_id and text; one document in ten, by its id, goes on from some word in copies of the words there.

    Invented prose hardly repeats itself with a period. With h the id's CRC-32 and g = h div
    10, a document with h % 10 = 0 becomes words 0 to a - 1, then the p words from a over and
    over up to its old length: a = g % n, p = 1 + (n - a) div (3 + g % 8).
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    docs = docs.select("doc_id", "text", (h % 10 == 0).alias("_replay"), F.call_function("div", h, F.lit(10)).alias("_g"))
    docs = docs.withColumn("_w", F.when(F.col("_replay"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    docs = docs.withColumn("_n", F.coalesce(F.size("_w"), F.lit(0))).withColumn("_a", F.expr("if(_n > 0, cast(_g % _n as int), 0)"))
    docs = docs.withColumn("_p", F.expr("cast(1 + (_n - _a) div (3 + _g % 8) as int)"))
    words = F.expr("array_join(transform(sequence(0, _n - 1), i -> element_at(_w, 1 + if(i < _a, i, _a + (i - _a) % _p))), ' ')")
    return docs.select("doc_id", F.when(F.col("_n") > 0, words).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(replayed_documents(table(spark, sf_dir, "documents")))
    # the longest run; of several the first, then that of the least period
    found = found.withColumn("best", F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))"))
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_shard": op2_shard,
        "op3_language": op3_language,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_language_model": op5_language_model,
        "op6_benchmark_passages": op6_benchmark_passages,
        "op7_chroma": op7_chroma,
        "op8_token_counts": op8_token_counts,
        "op9_chat": op9_chat,
        "op10_url_lists": op10_url_lists,
        "op11_source_divergence": op11_source_divergence,
        "op12_warc": op12_warc,
        "op13_periodic_runs": op13_periodic_runs,
        "pipeline": pipeline,
    }


WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

SQL = {
    "op1_mix_sources": rf"""
WITH sized AS (
  SELECT doc_id, source, {WORDS} AS size, text,
         cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id AS varchar), '')), 1, 15) AS bigint) AS place
  FROM documents),
sums AS (SELECT source, sum(size)::bigint AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, source_size * 3 AS cap FROM sums),
levels AS (SELECT *, cap / weight AS lv FROM ranked),
run AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS share
  FROM levels WINDOW w AS (ORDER BY lv, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, lv < rest::double / share AS stopped FROM run),
lam AS (SELECT arg_min(rest::double / share, lv) AS common FROM flagged WHERE NOT stopped),
targets AS (SELECT source, source_size, CASE WHEN stopped THEN cap::double ELSE weight * common END AS target FROM flagged, lam),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, row_number() OVER (ORDER BY s.source NULLS LAST, place, s.doc_id, s.size) AS rn,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY place, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
draws AS (
  SELECT rn, size, copy, (copy * source_size + upto) / target AS finish FROM placed, range(3) AS c(copy)
  WHERE size > 0 AND copy * source_size + upto <= target),
mixed AS (SELECT *, sum(size) OVER (ORDER BY finish, rn, copy ROWS UNBOUNDED PRECEDING) - size AS ahead FROM draws),
taken AS (SELECT rn, sum(size)::bigint AS taken, min(ahead)::bigint AS first_drawn_at FROM mixed WHERE ahead + size <= (SELECT sum(source_size) FROM sums) GROUP BY rn)
SELECT doc_id, size::bigint AS size, source_size, target, coalesce(taken, 0) AS taken, first_drawn_at FROM placed LEFT JOIN taken USING (rn)""",
    "op2_shard": r"""
WITH nibbles AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(4), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(16) r(i))),
crcs AS (
  SELECT DISTINCT text, CASE WHEN text IS NOT NULL THEN xor(4294967295, list_reduce(
    [4294967295::bigint] || list_transform(range(2 * strlen(text)), lambda i: ('0x' || hex(encode(text))[(i + 1 + 1 - 2 * (i % 2))::int])::bigint),
    lambda c, b: xor(c >> 4, t[(xor(c, b) & 15) + 1]))) END AS crc
  FROM documents, nibbles),
sized AS (SELECT doc_id, coalesce(strlen(d.text), 0) + 16 AS size, crc FROM documents d JOIN crcs c ON d.text IS NOT DISTINCT FROM c.text),
placed AS (SELECT *, sum(size) OVER (ORDER BY crc NULLS FIRST, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS ahead, sum(size) OVER () AS total FROM sized),
dealt AS (SELECT *, least(39, ((2 * ahead + size) * 40) // (2 * total))::int AS shard FROM placed)
SELECT doc_id, size::bigint AS size, crc::bigint AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY crc NULLS FIRST, doc_id NULLS FIRST, size) - 1 AS slot, NULL::int AS grown_shard
FROM dealt""",
    "op4_near_duplicates": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
numbered AS (SELECT doc_id, dense_rank() OVER (ORDER BY s) AS s FROM shingles),
sizes AS (SELECT doc_id, count(*) AS n FROM numbered GROUP BY doc_id),
sized AS (SELECT doc_id, s, n FROM numbered JOIN sizes USING (doc_id)),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sized a JOIN sized b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, t.b FROM reach r JOIN edges t ON r.b = t.a)
SELECT a AS doc_id, coalesce(any_value(n), 0)::bigint AS n_shingles, min(b) AS component_id, a = min(b) AS kept
FROM reach LEFT JOIN sizes ON a = sizes.doc_id GROUP BY a""",
    "op9_chat": """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
convs AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS l FROM turns
  GROUP BY conv_id, CASE WHEN conv_id IS NULL THEN {'n': turn, 'r': role, 't': text} END),
wholes AS (SELECT min(conv_id) AS conv_id, l, count(*) AS n_copies FROM convs GROUP BY l),
shorter AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(range(1, len(l))) AS k FROM convs))
SELECT conv_id, len(l) AS n_turns, n_copies,
       list_aggregate(list_transform(l, lambda x: '<|' || coalesce(x.r, 'unknown') || '|>' || chr(10) || coalesce(x.t, '') || chr(10)), 'string_agg', '') AS rendered
FROM wholes w WHERE NOT EXISTS (SELECT 1 FROM shorter s WHERE s.l = w.l)""",
    "op10_url_lists": r"""
WITH urls AS (
  SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+)', 1) AS folder,
         DATE '2024-01-01' + ((page_id * 7) % 360)::int AS fetched_on
  FROM pages),
named AS (SELECT * FROM urls WHERE url IS NOT NULL AND page_id IS NOT NULL AND host <> ''),
h AS (SELECT host AS pattern, min(page_id) AS p FROM named GROUP BY 1),
d AS (SELECT array_to_string(string_split(host, '.')[-2:], '.') AS pattern, min(page_id) AS p FROM named GROUP BY 1),
f AS (SELECT host || folder AS pattern, min(page_id) AS p FROM named WHERE folder <> '' GROUP BY 1),
entries AS (
  SELECT 'hosts' AS l, pattern, (p * 13) % 300 + 0 AS n, CASE WHEN p % 3 = 0 THEN 'allow' ELSE 'block' END AS action FROM h
  UNION ALL SELECT 'hosts', pattern, (p * 13) % 300 + 45, 'remove' FROM h
  UNION ALL SELECT 'hosts', pattern, (p * 13) % 300 + 120, 'block' FROM h
  UNION ALL SELECT 'domains', pattern, (p * 29) % 300, 'block' FROM d
  UNION ALL SELECT 'domains', pattern, (p * 29) % 300 + 60, 'allow' FROM d
  UNION ALL SELECT 'domains', pattern, (p * 29) % 300 + 90, 'remove' FROM d
  UNION ALL SELECT 'folders', pattern, (p * 17) % 300, CASE WHEN p % 2 = 0 THEN 'allow' ELSE 'block' END FROM f
  UNION ALL SELECT 'folders', pattern, (p * 17) % 300 + 30, 'remove' FROM f),
spans AS (
  SELECT l, pattern, action, DATE '2024-01-01' + n::int AS valid_from, DATE '2024-01-01' + (lead(n) OVER (PARTITION BY l, pattern ORDER BY n))::int AS valid_to FROM entries),
active AS (
  SELECT u.page_id, u.url, u.fetched_on, s.pattern, s.action, s.valid_from,
         row_number() OVER (PARTITION BY u.page_id, u.url ORDER BY length(s.pattern) DESC, s.action DESC, s.pattern DESC, s.valid_from DESC) AS rn
  FROM urls u JOIN spans s ON s.action <> 'remove' AND u.fetched_on >= s.valid_from AND (s.valid_to IS NULL OR u.fetched_on < s.valid_to)
   AND (u.host = s.pattern OR ends_with(u.host, '.' || s.pattern) OR (u.folder <> '' AND u.host || u.folder = s.pattern)))
SELECT u.page_id, u.url, u.fetched_on, coalesce(a.action, 'none') AS verdict, a.pattern, a.valid_from
FROM urls u LEFT JOIN active a ON a.rn = 1 AND a.page_id = u.page_id AND a.url = u.url""",
    "op11_source_divergence": r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
words AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS of_lang FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
every AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::hugeint * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM every),
usual AS (
  SELECT lang, term, 1 + (1000000000::hugeint * (of_lang + 5)) // (sum(of_lang) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM kept),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::bigint AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, (p - q)::bigint FROM shares s JOIN usual u ON s.lang = u.lang AND s.term = u.term WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::int AS rank FROM found
QUALIFY part = 'pair' OR rank <= 50""",
    "op12_warc": """
WITH p AS (SELECT page_id, row_number() OVER () AS r, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, r, payload, strlen(payload) AS payload_bytes, last_value(struct_pack(page_id, r)) OVER (PARTITION BY payload ORDER BY page_id NULLS FIRST, r ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS f FROM p)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN payload_bytes < 1000 OR f.r = r THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND f.r <> r THEN f.page_id END AS refers_to
FROM d""",
    "op13_periodic_runs": r"""
WITH nibbles AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(4), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(16) r(i))),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(4294967295, list_reduce(
           [4294967295::bigint] || list_transform(range(2 * strlen(k)), lambda i: ('0x' || hex(encode(k))[(i + 1 + 1 - 2 * (i % 2))::int])::bigint),
           lambda c, b: xor(c >> 4, t[(xor(c, b) & 15) + 1]))) AS h
  FROM (SELECT *, coalesce(cast(doc_id AS varchar), '') AS k FROM documents), nibbles),
sized AS (SELECT r, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS replay, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM docs),
words AS (
  SELECT r, n, i, w[1 + CASE WHEN replay AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM sized)),
numbered AS (SELECT *, dense_rank() OVER (ORDER BY word) AS id FROM words),
equal AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM numbered x JOIN numbered y ON x.r = y.r AND x.id = y.id AND y.i > x.i AND y.i - x.i <= x.n // 4),
stretches AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM equal)
  GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (r, i) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_runs, first(struct_pack(start, length, period) ORDER BY length DESC, start, period) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period, 1000 * best.length // best.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM docs LEFT JOIN found USING (r) LEFT JOIN kept USING (r)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
