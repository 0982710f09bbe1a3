"""Queries on scripts, templates, markup and wording of values."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from lexiframe.functions import text as tx
from lexiframe.operators.structure import assemble_fragments
from lexiframe.registry import Registry
from lexiframe.session import expose_package
from lexiframe.sources.tables import table


def script_sql(column: str) -> str:
    hits = " || ".join(f"CASE WHEN regexp_matches({column}, '{pattern}') THEN '{name},' ELSE '' END" for name, pattern in tx.SCRIPTS.items())
    return f"CASE len(string_split({hits}, ',')) - 1 WHEN 0 THEN 'none' WHEN 1 THEN replace({hits}, ',', '') ELSE 'mixed' END"


TEMPLATE_SQL = "'Order :orderKey for %s of :order http://x/:o' || o_orderkey % 7 || ' _TOTAL_ 5% ' || CASE WHEN o_orderstatus = 'F' THEN ':days %s' ELSE '_MENU_' END"


#: The other language's form, which misses a placeholder for some orders and has one too many for others.
TRANSLATION_SQL = "'%s _TOTAL_ :order, :orderKey ' || CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderstatus = 'F' THEN '%s :days' ELSE '_MENU_' END || ' http://x/:o' || CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 7 END"


def templates(spark, d):
    orders = table(spark, d, "orders")
    tail = F.when(F.col("o_orderstatus") == "F", ":days %s").otherwise("_MENU_")
    template = F.concat(F.lit("Order :orderKey for %s of :order http://x/:o"), (F.col("o_orderkey") % 7).cast("string"), F.lit(" _TOTAL_ 5% "), tail)
    return orders.withColumn("template", template)


class Tokens:
    """Placeholders of a template, one row each; the Python form of ``template_tokens``."""

    def eval(self, key: int, template: str):
        import re

        for pos, token in enumerate(re.findall(tx.TOKEN, template or "")):
            yield key, pos, token


def register(r: Registry) -> None:
    @r.query(
        "script_class",
        "O-13: translation shows in the script",
        f"SELECT lang, {script_sql('text')} AS script, count(*) AS n FROM documents GROUP BY ROLLUP (lang, script)",
    )
    def _(spark, d):
        docs = table(spark, d, "documents").select("lang", tx.script_class(F.col("text")).alias("script"))
        return docs.rollup("lang", "script").agg(F.count("*").alias("n"))

    @r.query(
        "coverage_by_group",
        "share of translated entries",
        f"""SELECT lang, source, count(*) AS n, round(count(*) FILTER ({script_sql('text')} <> 'latin') / count(*), 6) AS coverage
            FROM documents GROUP BY ROLLUP (lang, source)""",
    )
    def _(spark, d):
        docs = table(spark, d, "documents").select("lang", "source", (tx.script_class(F.col("text")) != "latin").alias("covered"))
        return docs.rollup("lang", "source").agg(F.count("*").alias("n"), F.round(F.count_if("covered") / F.count("*"), 6).alias("coverage"))

    @r.query(
        "coverage_transition",
        "scripts before and after, crossed",
        f"""WITH c AS (SELECT doc_id, {script_sql('text')} AS script FROM documents)
            SELECT a.script AS before, b.script AS after, count(*) AS n FROM c a JOIN c b ON b.doc_id = a.doc_id + 1 GROUP BY ALL""",
    )
    def _(spark, d):
        docs = table(spark, d, "documents").select("doc_id", tx.script_class(F.col("text")).alias("script"))
        before = docs.select((F.col("doc_id") + 1).alias("doc_id"), F.col("script").alias("before"))
        return before.join(docs.withColumnRenamed("script", "after"), "doc_id").groupBy("before", "after").agg(F.count("*").alias("n"))

    @r.query(
        "template_tokens",
        "O-14 to O-16: placeholders of all dialects",
        f"""WITH t AS (SELECT o_orderkey, regexp_extract_all({TEMPLATE_SQL}, '{tx.TOKEN}', 1) AS tokens FROM orders),
            u AS (SELECT o_orderkey, (generate_subscripts(tokens, 1) - 1)::INT AS pos, unnest(tokens) AS token FROM t)
            SELECT *, CASE WHEN token = '%s' THEN 'positional' WHEN token LIKE ':%' THEN 'named' ELSE 'widget' END AS dialect FROM u""",
    )
    def _(spark, d):
        tokens = templates(spark, d).select("o_orderkey", F.posexplode(tx.template_tokens(F.col("template"))).alias("pos", "token"))
        return tokens.withColumn("dialect", tx.dialect(F.col("token")))

    @r.query(
        "template_parity",
        "a translation keeps every placeholder",
        f"""WITH t AS (SELECT o_orderkey, {TEMPLATE_SQL} AS one, {TRANSLATION_SQL} AS other FROM orders)
            SELECT o_orderkey, list_sort(regexp_extract_all(one, '{tx.TOKEN}', 1)) = list_sort(regexp_extract_all(other, '{tx.TOKEN}', 1)) AS parity FROM t""",
    )
    def _(spark, d):
        return templates(spark, d).select("o_orderkey", tx.same_tokens(F.col("template"), F.expr(TRANSLATION_SQL)).alias("parity"))

    @r.query(
        "render_named",
        "O-15: the longest name first",
        "SELECT o_orderkey, c_name || ' owes ' || o_orderkey || '/' || o_orderstatus || 'Key' AS rendered FROM orders JOIN customer ON o_custkey = c_custkey",
    )
    def _(spark, d):
        joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        names = {"order": F.concat("o_orderstatus", F.lit("Key")), "orderKey": F.col("o_orderkey"), "customer": F.col("c_name")}
        return joined.select("o_orderkey", tx.render_named(F.lit(":customer owes :orderKey/:order"), names).alias("rendered"))

    @r.query(
        "render_positional",
        "O-14: places filled in order, literal percent kept",
        "SELECT o_orderkey, c_name || ': 100% of ' || o_orderstatus || ' in ' || c_mktsegment AS rendered FROM orders JOIN customer ON o_custkey = c_custkey",
    )
    def _(spark, d):
        joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        values = [F.col("c_name"), F.col("o_orderstatus"), F.col("c_mktsegment")]
        return joined.select("o_orderkey", tx.render_positional(F.lit("%s: 100% of %s in %s"), values).alias("rendered"))

    @r.query(
        "markup_tags",
        "O-17: inline tags",
        f"SELECT page_id, lower(tag) AS tag, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '{tx.TAG}', 1)) AS tag FROM pages) GROUP BY ALL",
    )
    def _(spark, d):
        return table(spark, d, "pages").select("page_id", F.explode(tx.tags(F.col("html"))).alias("tag")).groupBy("page_id", "tag").agg(F.count("*").alias("n"))

    @r.query(
        "markup_balance",
        "O-17: paired tags balance",
        "SELECT page_id, (len(regexp_extract_all(html, '<p[ >]')) - len(regexp_extract_all(html, '</p>')))::INT AS p, (len(regexp_extract_all(html, '<li[ >]')) - len(regexp_extract_all(html, '</li>')))::INT AS li FROM pages",
    )
    def _(spark, d):
        html = F.col("html")
        return table(spark, d, "pages").select("page_id", tx.tag_balance(html, "p").alias("p"), tx.tag_balance(html, "li").alias("li"))

    @r.query("entity_counts", "O-18: entities", f"SELECT page_id, len(regexp_extract_all(html, '{tx.ENTITY}'))::INT AS n FROM pages")
    def _(spark, d):
        return table(spark, d, "pages").select("page_id", F.size(tx.entities(F.col("html"))).alias("n"))

    @r.query(
        "entity_lint",
        "O-19: bare ampersands beside entities",
        f"SELECT page_id, (len(regexp_extract_all(html, '&')) - len(regexp_extract_all(html, '{tx.ENTITY}')))::INT AS bare FROM pages",
    )
    def _(spark, d):
        return table(spark, d, "pages").select("page_id", tx.bare_ampersands(F.col("html")).alias("bare"))

    @r.query(
        "length_profile",
        "characters are not bytes",
        """SELECT lang, min(length(text))::INT AS shortest, max(length(text))::INT AS longest, quantile_cont(length(text), 0.9) AS p90, sum(strlen(text))::BIGINT AS bytes
           FROM documents GROUP BY lang""",
    )
    def _(spark, d):
        chars = F.length("text")
        return table(spark, d, "documents").groupBy("lang").agg(
            F.min(chars).alias("shortest"), F.max(chars).alias("longest"), F.percentile(chars, 0.9).alias("p90"), F.sum(F.octet_length("text").cast("long")).alias("bytes")
        )

    @r.query("shared_values", "keys that share one text", "SELECT md5(text) AS value, count(*) AS keys, min(doc_id) AS first_key FROM documents GROUP BY text HAVING count(*) > 1")
    def _(spark, d):
        docs = table(spark, d, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("value"))
        return docs.groupBy("value").agg(F.count("*").alias("keys"), F.min("doc_id").alias("first_key")).where("keys > 1")

    @r.query(
        "glossary_conflicts",
        "one source text with several translations",
        "SELECT p_name, count(DISTINCT p_type) AS translations, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS shown FROM part GROUP BY p_name HAVING count(DISTINCT p_type) > 1",
    )
    def _(spark, d):
        found = table(spark, d, "part").groupBy("p_name").agg(F.sort_array(F.collect_set("p_type")).alias("types"))
        return found.where(F.size("types") > 1).select("p_name", F.size("types").cast("long").alias("translations"), F.array_join("types", ",").alias("shown"))

    @r.query(
        "whitespace_lint",
        "blanks at edges and doubled ones are reported",
        f"SELECT doc_id, len(regexp_extract_all(text, '{tx.ODD_BLANKS}'))::INT AS odd, len(regexp_extract_all(' ' || text || '  ', '{tx.ODD_BLANKS}'))::INT AS odd_padded FROM documents",
    )
    def _(spark, d):
        padded = F.concat(F.lit(" "), F.col("text"), F.lit("  "))
        return table(spark, d, "documents").select("doc_id", tx.odd_blanks(F.col("text")).alias("odd"), tx.odd_blanks(padded).alias("odd_padded"))

    @r.query(
        "render_widget",
        "O-16: _NAME_ replaced by its value",
        "SELECT o_orderkey, 'from ' || o_orderkey || ' to ' || o_custkey || ' of ' || o_orderstatus || ' _OTHER_' AS rendered FROM orders",
    )
    def _(spark, d):
        values = {"FIRST": F.col("o_orderkey"), "LAST": F.col("o_custkey"), "ALL": F.col("o_orderstatus")}
        return table(spark, d, "orders").select("o_orderkey", tx.render_widget(F.lit("from _FIRST_ to _LAST_ of _ALL_ _OTHER_"), values).alias("rendered"))

    @r.query(
        "fragment_families",
        "O-20: fragments found by their numbered keys",
        r"""WITH k AS (SELECT regexp_replace(p_brand || 'text' || p_size, '\d+$', '') AS stem, p_size AS number, p_name FROM part WHERE p_partkey % 9 <> 0)
            SELECT stem, count(*) AS fragments, string_agg(p_name, ' ' ORDER BY number, p_name) AS whole FROM k GROUP BY stem""",
    )
    def _(spark, d):
        number = F.when(F.col("p_partkey") % 9 != 0, F.col("p_size").cast("string")).otherwise("")
        rows = table(spark, d, "part").select(F.concat("p_brand", F.lit("text"), number).alias("key"), "p_name")
        return assemble_fragments(rows, "key", "p_name")

    @r.query(
        "literal_decode",
        "O-06/07: escapes of quoted literals",
        r"""SELECT o_orderkey, 'say "' || o_orderstatus || '"' || CASE WHEN o_orderkey % 2 = 0 THEN chr(10) ELSE '\n' END || '\' || 'n' AS value FROM orders""",
    )
    def _(spark, d):
        orders = table(spark, d, "orders")
        double = F.concat(F.lit('say \\"'), F.col("o_orderstatus"), F.lit('\\"\\n\\\\n'))
        single = F.concat(F.lit('say "'), F.col("o_orderstatus"), F.lit('"\\n\\\\n'))
        even = F.col("o_orderkey") % 2 == 0
        quote = F.when(even, '"').otherwise("'")
        return orders.select("o_orderkey", tx.decode_literal(F.when(even, double).otherwise(single), quote).alias("value"))

    @r.query(
        "fragment_assemble",
        "O-20: numbered fragments joined in order",
        "SELECT conv_id, count(*) AS fragments, string_agg(text, ' ' ORDER BY turn, text) AS whole FROM conversations GROUP BY conv_id",
    )
    def _(spark, d):
        ordered = F.sort_array(F.collect_list(F.struct("turn", "text")))
        whole = table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("fragments"), ordered.alias("parts"))
        return whole.select("conv_id", "fragments", F.array_join("parts.text", " ").alias("whole"))

    @r.query(
        "token_udtf",
        "placeholders by a Python table function",
        f"""WITH t AS (SELECT o_orderkey, regexp_extract_all({TEMPLATE_SQL}, '{tx.TOKEN}', 1) AS tokens FROM orders)
            SELECT o_orderkey, (generate_subscripts(tokens, 1) - 1)::INT AS pos, unnest(tokens) AS token FROM t""",
    )
    def _(spark, d):
        expose_package(spark)
        spark.udtf.register("lexi_tokens", udtf(Tokens, returnType="o_orderkey bigint, pos int, token string"))
        templates(spark, d).select("o_orderkey", "template").createOrReplaceTempView("lexi_templates")
        return spark.sql("SELECT u.* FROM lexi_templates t, LATERAL lexi_tokens(t.o_orderkey, t.template) u")
