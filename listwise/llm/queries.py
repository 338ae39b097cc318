"""The queries of this subpackage over the given tables, with their SQL where it can say them."""

import public_tokenizers
from pyspark.sql import functions as F

from listwise.llm import chat, decontaminate, fingerprints, langid, lines, mixing, neardup, packing, pii, repair, scoring, warc, whitening
from listwise.llm.common import crc_mod, own_dir, table

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


_SHIELDED = "replace(text, '\\', '\\\\')"
for _c in chat.CONTROL:
    _SHIELDED = f"replace({_SHIELDED}, '{_c}', '{_c[0]}\\{_c[1:]}')"
_ROLE_SHIELDED = _SHIELDED.replace("(text,", "(role,")


@query("op1_chat_format", f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown AS (
  SELECT *, length({_SHIELDED}) AS n, length({_ROLE_SHIELDED}) AS r FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 10 ELSE 19 + r END) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id""")
def op1(spark, sf):
    """All conversations, and one that holds control strings, formatted and read back."""
    extra = spark.createDataFrame([(-1, t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_chat(turns))


@query("op6_language_id")
def op6(spark, sf):
    """The language of every document, learned from labelled rows that are not held out."""
    documents = table(spark, sf, "documents")
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = langid.learn(documents.where(~held))
    return langid.predict(documents, model).withColumn("held_out", held).select("doc_id", "held_out", "lang_pred", "score")


@query("op9_packing")
def op9(spark, sf):
    """All documents packed into sequences of at most 2048 ids, with a checksum of each piece."""
    pieces = packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op10_personal_data")
def op10(spark, sf):
    """Personal data in every document."""
    found = pii.find_pii(table(spark, sf, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin("email", "ip", "card", "phone"))
    return found.select("doc_id", *(count(k) for k in ("email", "ip", "card", "phone")),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        F.size("spans").cast("long").alias("n_found"), F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("risk"))


@query("op3_decontamination")
def op3(spark, sf):
    """Documents that overlap a benchmark item."""
    return decontaminate.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op7_near_duplicates", """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM w UNION SELECT b, root FROM reach JOIN links ON a = reach.doc_id),
top AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM top LEFT JOIN n USING (doc_id)""")
def op7(spark, sf):
    """Components of near-duplicates over all documents."""
    return neardup.near_duplicates(table(spark, sf, "documents"))


@query("op8_fingerprints")
def op8(spark, sf):
    """Sketches of all documents and of their edited texts."""
    out = fingerprints.compare_edited(table(spark, sf, "documents"))
    return out.select("doc_id", "n_chars", "edited_sha256", fingerprints.shown(F.col("sketch")).alias("fingerprint"),
                      fingerprints.shown(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")


@query("op5_lm_scoring")
def op5(spark, sf):
    """Every document scored by a model learned from those that are not held out."""
    return scoring.score_texts(table(spark, sf, "documents"))


@query("op2_line_dedup", """
WITH x AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents),
k AS (SELECT *, list_filter(regexp_split_to_array(regexp_replace(line, '\\S*[0-9]\\S*', '<*>', 'g'), '\\s+'), lambda t: t <> '') AS tok FROM x),
dl AS (SELECT tok, doc_id, min(no) AS no FROM k WHERE len(tok) > 0 GROUP BY tok, doc_id),
pl AS (SELECT tok, len(tok) AS size, tok[1:4] AS head, count(*) AS n FROM dl GROUP BY tok),
leaf AS (SELECT size, head FROM pl GROUP BY size, head HAVING sum(n) >= 5),
spot AS (SELECT tok, size, head, n, unnest(tok) AS token, generate_subscripts(tok, 1) AS p FROM pl JOIN leaf USING (size, head)),
rare AS (SELECT size, head, p, token, sum(n) < 5 AS rare FROM spot GROUP BY ALL),
tm AS (SELECT tok, list(CASE WHEN rare THEN '<*>' ELSE token END ORDER BY p) AS t FROM spot JOIN rare USING (size, head, p, token)
       GROUP BY tok HAVING sum(CAST(rare AS INTEGER)) <= 0.3::DOUBLE * count(*)),
rc AS (SELECT t, min((doc_id, no)) AS first FROM dl JOIN tm USING (tok) GROUP BY t HAVING count(DISTINCT doc_id) >= 5),
gone AS (SELECT doc_id, no FROM k JOIN tm USING (tok) JOIN rc USING (t) WHERE (doc_id, no) <> first),
kept AS (SELECT k.doc_id, count(*) FILTER (len(tok) > 0) AS n_lines, count(gone.no) AS n_dropped,
           string_agg(line, chr(10) ORDER BY k.no) FILTER (gone.no IS NULL) AS text FROM k LEFT JOIN gone ON gone.doc_id = k.doc_id AND gone.no = k.no GROUP BY k.doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k USING (doc_id)""")
def op2(spark, sf):
    """Every document without the lines of recurring templates."""
    return lines.dedup_lines(table(spark, sf, "documents"))


@query("op4_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f""")
def op4(spark, sf):
    """All pages written to archives and read back through the capture index."""
    pages = table(spark, sf, "pages")
    folder = own_dir(spark, "warc")
    shards = warc.index(warc.write(pages, folder), folder)
    records = warc.read(warc.lookup(warc.surts(pages), shards, folder), folder)
    whole = F.col("payload").isNotNull()
    return records.select(F.col("page").try_cast("long").alias("page_id"),
                          F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                          F.when(whole, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
                          "record_type", F.col("refers_to").try_cast("long").alias("refers_to"))


# One step of the repair: what a turn's edits cost from each state (struct: cost, edits, repaired turns), then insertions before it.
def _edit(cost, letter, state, shown=None):
    rest = f"{state}.o" if shown is None else f"{shown} || CASE WHEN {state}.o = '' THEN '' ELSE chr(10) || {state}.o END"
    return f"{{'c': {state}.c + {cost}, 'a': '{letter}' || {state}.a, 'o': {rest}}}"


def _choices(state, takes, keeps):
    """Keep, re-role and delete from a state, as a list; ``keeps``: (initial, state after it)."""
    role = {"w2": "user", "w3": "assistant"}[takes]
    kept = "".join(f"WHEN initial = '{i}' THEN [{_edit('cut', 'K', after, 'line')}] " for i, after in keeps)
    none = "list_filter([w0], lambda x: false)"
    return (f"list_min([{_edit(4, 'D', state)}] || CASE WHEN gone THEN {none} ELSE [{_edit('3 + cut', 'R', takes, f"'{role}:' || text")}] "
            f"|| CASE {kept}ELSE {none} END END)")


def _insert(role, state):
    return _edit(3, "I", state, f"'{role}:'")


@query("op11_conversation_repair", f"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
crc AS (SELECT k, xor(4294967295, list_reduce(list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda h, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(h, b)), 4294967295)) % 20 AS d
  FROM (SELECT DISTINCT k FROM src)),
dm AS (SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE d WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM src JOIN crc USING (k) WHERE d <> 0),
ob AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM dm),
nb AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair FROM ob),
ft AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM nb),
rw AS (SELECT conv_id, i, text, role || ':' || text AS line, left(role, 1) AS initial, fault IN ('blank', 'duplicate') AS gone,
    CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS cut FROM ft),
dp(conv_id, i, w0, w1, w2, w3) AS (
  SELECT conv_id, max(i) + 1, {{'c': 0, 'a': '', 'o': ''}}, {{'c': 6, 'a': 'II', 'o': 'user:' || chr(10) || 'assistant:'}},
    {{'c': 3, 'a': 'I', 'o': 'assistant:'}}, {{'c': 0, 'a': '', 'o': ''}} FROM rw GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, list_min([b0, {_insert('user', 'y2')}]), list_min([b1, {_insert('user', 'y2')}]), y2, y3 FROM (
    SELECT *, list_min([b2, {_insert('assistant', 'b3')}]) AS y2, list_min([b3, {_insert('user', 'b2')}]) AS y3 FROM (
      SELECT rw.conv_id, rw.i, {_choices("w0", "w2", (("s", "w1"), ("u", "w2")))} AS b0, {_choices("w1", "w2", (("u", "w2"),))} AS b1,
        {_choices("w2", "w3", (("a", "w3"),))} AS b2, {_choices("w3", "w2", (("u", "w2"),))} AS b3
      FROM dp JOIN rw ON rw.conv_id IS NOT DISTINCT FROM dp.conv_id AND rw.i = dp.i - 1))),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM ft GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(w0.c, 0) AS BIGINT) AS cost,
  coalesce(w0.a, '') AS audit, sha256(coalesce(w0.o, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN dp ON dp.conv_id IS NOT DISTINCT FROM c.conv_id AND dp.i = 1""")
def op11(spark, sf):
    """Every conversation, damaged by a fixed rule, and the cheapest repair of it."""
    return repair.repair_damaged(table(spark, sf, "conversations"))


def _hash(z):
    """``mixing.hashed`` as SQL."""
    z = f"(({z}) % {mixing.PRIME})"
    for m, shift in zip(mixing.MULTIPLIERS, (15, 13, 17)):
        z = f"(({z} * {m} + 12345) % {mixing.PRIME})"
        z = f"(xor({z}, {z} >> {shift}) % {mixing.PRIME})"
    return z


def _round_key(which):
    return _hash(f"((rank * 8 + epoch) * {mixing.ROUNDS} + r) * 4 + {which} + {mixing.SEED * 65537}")


@query("op12_source_mixing", f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s0),
s2 AS (SELECT *, CAST([5, 2, 1][(rank - 1) % 3 + 1] AS DOUBLE) AS weight FROM s1),
s3 AS (SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS rest,
    sum(weight) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM s2),
s4 AS (SELECT *, 3 * source_size / weight >= rest / share AS free FROM s3),
lv AS (SELECT rest AS l, share AS sh FROM s4 WHERE free ORDER BY source_size / weight, rank LIMIT 1),
s5 AS (SELECT rank, source, source_size, CASE WHEN free THEN l * weight / sh ELSE 3.0::DOUBLE * source_size END AS target,
    CAST(ceil(source_size / {mixing.BLOCK}) AS BIGINT) AS blocks FROM s4, lv),
s AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target * blocks / source_size + 0.5) AS BIGINT), 3 * blocks) ELSE 0 END AS quota FROM s5),
ks AS (SELECT rank, epoch, list(({_round_key(0)} * {mixing.PRIME} + {_round_key(1)}) % blocks ORDER BY r) AS mirror,
    list({_round_key(2)} % {mixing.PRIME - 1} + 1 ORDER BY r) AS by_, list({_round_key(3)} ORDER BY r) AS plus
  FROM s, range(3) AS e(epoch), range({mixing.ROUNDS}) AS q(r) WHERE blocks > 0 GROUP BY rank, epoch),
j AS (SELECT rank, blocks, unnest(range(quota)) AS j FROM s WHERE blocks > 0),
b AS (SELECT rank, list_reduce(range({mixing.ROUNDS}), lambda x, r:
      CASE WHEN ((greatest(x, (mirror[r + 1] - x + blocks) % blocks) % {mixing.PRIME} * by_[r + 1] + plus[r + 1]) % {mixing.PRIME}) >> 7 & 1 = 1
      THEN (mirror[r + 1] - x + blocks) % blocks ELSE x END, j % blocks) AS block
  FROM j JOIN ks USING (rank) WHERE epoch = j // blocks),
times AS (SELECT rank, block, count(*) AS times FROM b GROUP BY ALL),
p AS (SELECT doc_id, size, rank, row_number() OVER () AS id,
    CAST(sum(size) OVER (PARTITION BY rank ORDER BY doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
c AS (SELECT *, unnest(range(start // {mixing.BLOCK}, (start + size - 1) // {mixing.BLOCK} + 1)) AS block FROM p WHERE size > 0),
t AS (SELECT id, sum((least(start + size, (block + 1) * {mixing.BLOCK}) - greatest(start, block * {mixing.BLOCK})) * times) AS taken
  FROM c JOIN times USING (rank, block) GROUP BY id)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM p JOIN s USING (rank) LEFT JOIN t USING (id)""")
def op12(spark, sf):
    """How often the mix to the target weights takes the words of every document."""
    return mixing.taken(mixing.mix(table(spark, sf, "documents")))


@query("op13_embedding_whitening")
def op13(spark, sf):
    """The leading whitened coordinates of every embedding."""
    return whitening.whiten(table(spark, sf, "embeddings"))
