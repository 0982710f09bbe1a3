"""The parser, on one line for each trap, and properties of states and diffs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiframe.functions import text as tx
from lexiframe.operators import layers, state, structure
from lexiframe.sources.catalogue import after_sentinel, parse, read_lines, with_locale

LINES = [
    "<?php",
    "# Base words",
    "$_LANG['plain'] = \"one\";",
    "$_LANG['space key']['b'] = \"two\";",
    "$_LANG['a']['b/c']['d.e'] = \"three\";",
    "$_LANG['dot.ted'] = 'single $x \\n';",
    "$_LANG['quote'] = \"say \\\"hi\\\" to\\nyou\";",
    "$_LANG['slash'] = \"a\\\\nb\";",
    "$_LANG['note'] = \"five\"; # see above",
    "$_LANG['money'] = \"$ 5 and 5% off\";",
    "# Version 4.5.2",
    "$_LANG['plain'] = \"again\";",
    "// Menu",
    "$_LANG['open'] = \"never closed;",
    "$_LANG[bare] = \"x\";",
    "$_LANG['semi;colon'] = \"a; b\";",
    "# The end",
    "",
]


def frame(spark, lines):
    rows = [("f", n + 1, line) for n, line in enumerate(lines)]
    return spark.createDataFrame(rows, "file_id string, line_no bigint, text string")


def test_every_trap(spark):
    parsed = parse(frame(spark, LINES))
    found = {r.line_no: r for r in parsed.assignments.collect()}
    assert {n: list(r.path) for n, r in found.items()} == {
        3: ["plain"], 4: ["space key", "b"], 5: ["a", "b/c", "d.e"], 6: ["dot.ted"], 7: ["quote"], 8: ["slash"],
        9: ["note"], 10: ["money"], 12: ["plain"], 16: ["semi;colon"],
    }
    assert found[6].value == "single $x \\n" and found[6].quote == "'"
    assert found[7].value == 'say "hi" to\nyou' and found[7].raw_value == 'say \\"hi\\" to\\nyou'
    assert found[8].value == "a\\nb"
    assert found[9].note == "see above" and found[3].note is None
    assert found[10].value == "$ 5 and 5% off"
    assert (found[3].version, found[3].topic) == (None, "Base words")
    assert (found[12].version, found[12].topic) == ("4.5.2", None)
    assert (found[16].version, found[16].topic) == ("4.5.2", "Menu")
    assert [found[n].depth for n in (3, 4, 5)] == [1, 2, 3]
    assert [(r.line_no, r.reason) for r in parsed.quarantine.orderBy("line_no").collect()] == [(14, "unterminated value"), (15, "malformed assignment")]
    assert parsed.other.count() == len(LINES) - len(found) - 2


def test_lines_of_any_length(spark):
    long = 1_000_000
    lines = [
        "$_LANG['a'] = \"" + "v" * long + "\"; # " + "n" * long,
        "$_LANG['" + "k" * long + "'] = '" + "\\'" * (long // 2) + "';",
        "$_LANG['a'] = \"" + "\\n" * (long // 2),
        "$_LANG['" + "k" * long,
        "$_LANG" + "['a']" * 200_000 + " = \"x\";",
        "#" + " " * long + "x" + " " * long + "y",
        "$_LANG['b'] = 'end';",
    ]
    parsed = parse(frame(spark, lines))
    found = {r.line_no: r for r in parsed.assignments.select("line_no", F.length("value").alias("n"), F.length("note").alias("note"), "depth", F.length("topic").alias("topic")).collect()}
    assert {n: (r.n, r.note, r.depth, r.topic) for n, r in found.items()} == {1: (long, long, 1, None), 2: (long // 2, None, 1, None), 5: (1, None, 200_000, None), 7: (3, None, 1, long + 2)}
    assert [(r.line_no, r.reason) for r in parsed.quarantine.orderBy("line_no").collect()] == [(3, "unterminated value"), (4, "malformed assignment")]


def test_sentinel_and_locale(spark):
    rows = frame(spark, ["$_LANG['locale'] = \"aa_BB\";", "$_LANG['a'] = 'x';", "$_LANG['locale'] = \"cc_DD\";", "//// END of strings file. Stop", "$_LANG['late'] = 'y';", "$_LANG[broken"])
    assert [r.line_no for r in after_sentinel(rows).orderBy("line_no").collect()] == [5, 6]
    assert {r.locale for r in with_locale(parse(rows).assignments).collect()} == {"cc_DD"}
    assert after_sentinel(frame(spark, LINES)).count() == 0
    assert {r.locale for r in with_locale(parse(frame(spark, LINES)).assignments).collect()} == {None}


def test_null_and_empty_lines(spark):
    parsed = parse(frame(spark, [None, ""]))
    assert (parsed.assignments.count(), parsed.quarantine.count(), parsed.other.count()) == (0, 0, 2)
    assert parse(frame(spark, [])).assignments.count() == 0


def test_read_lines(spark, tmp_path):
    (tmp_path / "one.php").write_text("\n".join(LINES))
    (tmp_path / "two.php").write_text("$_LANG['x'] = \"y\";\r\n")
    lines = read_lines(spark, str(tmp_path))
    assert lines.count() == len(LINES) + 2
    assert parse(lines).assignments.where("path[0] = 'x'").first().value == "y"


log = st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(["1", "2", None])), max_size=8)
quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@quick
@given(log)
def test_last_write_wins(spark, writes):
    rows = spark.createDataFrame([(k, v, n) for n, (k, v) in enumerate(writes)], "k string, v string, n int")
    once = state.effective_state(rows, ["k"], "v", ["n"])
    assert {r.k: r.v for r in once.collect()} == dict(writes)
    assert {r.k: r.v for r in state.effective_rows(rows, ["k"], ["n"]).collect()} == dict(writes)
    again = state.effective_state(once.withColumn("n", F.lit(0)), ["k"], "v", ["n"])
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


@quick
@given(st.dictionaries(st.sampled_from("abcd"), st.sampled_from(["1", "2", None])), st.dictionaries(st.sampled_from("abcd"), st.sampled_from(["1", "2", None])))
def test_diff(spark, one, two):
    side = lambda d: spark.createDataFrame(list(d.items()), "k string, v string")
    status = lambda a, b: {r.k: r.status for r in layers.snapshot_diff(side(a), side(b), ["k"], "v").collect()}
    wanted = {k: "added" if k not in one else "removed" if k not in two else "unchanged" if one[k] == two[k] else "changed" for k in {*one, *two}}
    swap = {"added": "removed", "removed": "added"}
    assert status(one, two) == wanted
    assert status(two, one) == {k: swap.get(s, s) for k, s in wanted.items()}
    assert set(status(one, one).values()) <= {"unchanged"}
    assert layers.keys_only_in(side(two), side(one), ["k"]).count() == sum(s == "added" for s in wanted.values())


def value_of(spark, expression, **columns):
    row = [tuple(columns.values())]
    return spark.createDataFrame(row, ", ".join(f"{c} string" for c in columns)).select(expression.alias("x")).first().x


def test_templates(spark):
    tokens = lambda t: value_of(spark, tx.template_tokens(F.col("t")), t=t)
    assert tokens("%s of :name at http://x/ _TOTAL_ 99.9%") == ["%s", ":name", "_TOTAL_"]
    named = tx.render_named(F.col("t"), {"count": F.lit("3"), "countmonth": F.lit("May")})
    assert value_of(spark, named, t=":countmonth :countmo") == "May 3mo"
    assert value_of(spark, tx.render_positional(F.col("t"), [F.lit("a"), F.lit("b")]), t="<%s>100% x</%s> %s") == "<a>100% x</b> "
    assert value_of(spark, tx.same_tokens(F.lit("%s :a"), F.col("t")), t=":a x %s")


def test_markup_and_script(spark):
    html = "<br/>A<br />B <a href='x'>c</a> &amp; d & e &laquo;"
    assert value_of(spark, tx.tags(F.col("t")), t=html) == ["br", "br", "a", "a"]
    assert value_of(spark, tx.tag_balance(F.col("t"), "a"), t=html) == 0
    assert value_of(spark, tx.bare_ampersands(F.col("t")), t=html) == 1
    script = lambda t: value_of(spark, tx.script_class(F.col("t")), t=t)
    assert [script(t) for t in ("abc", "აბ", "aა", "12", "", None)] == ["latin", "georgian", "mixed", "none", "none", None]
    assert value_of(spark, tx.odd_blanks(F.col("t")), t=" a  b ") == 3
    family = value_of(spark, tx.fragment_family(F.col("t")), t="welcome12")
    assert (family.stem, family.number) == ("welcome", 12)


def test_versions(spark):
    key = lambda t: value_of(spark, structure.version_key(F.col("t")), t=t)
    assert key("10.1") > key("9.2.3") and key("4.5.2") > key("4.5")


def test_override_null_replaces(spark):
    base = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    over = spark.createDataFrame([("a", None), ("z", "9")], "k string, v string")
    merged = {r.k: (r.v, r.overridden) for r in layers.override_merge(base, over, ["k"], "v").collect()}
    assert merged == {"a": (None, True), "b": ("2", False)}
