from cellgrid.llm import url_filter as U


def _judge(spark, urls):
    pages = spark.createDataFrame([(i, u, "extra") for i, u in enumerate(urls)], "page_id long, url string, host string")
    return [tuple(r)[1:] for r in U.judge(pages, U.rule_table(spark, U.production_rules())).orderBy("page_id").collect()]


def test_domain_rules_longest_wins_and_paths_are_case_sensitive(spark):
    got = _judge(spark, ["HTTP://A.NeT/x", "http://xnet/", "http://net", "://example.net/en/", "http://EXAMPLE.net/EN/", "http://my.example.com/de/1",
                         "http://a.org/fr/utm_source=1\nb", "http://net/?a://b", "http://\u212a.net/"])
    assert got == [("a.net", "/x", "net/", "block"), ("xnet", "/", None, "allow"), ("net", "", None, "allow"),
                   ("example.net", "/en/", "example.net/en/", "allow"), ("example.net", "/EN/", "net/", "block"),
                   ("my.example.com", "/de/1", "example.com/de/", "block"), ("a.org", "/fr/utm_source=1\nb", "org/fr/", "allow"),
                   ("net", "/", "net/", "block"), ("\u212a.net", "/", "net/", "block")]


def test_patterns_decide_where_no_domain_rule_fits(spark):
    got = _judge(spark, ["https://a.com/x?UTM_source=1", "https://a.com/es/1?page=2", "https://a.com/es/1", "https://a.com/track", "https://a.com/tracker",
                         "https://a.com/x.html", "no scheme utm_source=2"])
    assert [v for *_, v in got] == ["block", "allow", "block", "block", "allow", "allow", "block"]


def test_nulls_repeats_and_empty_tables(spark):
    got = _judge(spark, [None, "", "http://b.net/", "http://b.net/"])
    assert got[0] == ("", "", None, "allow") and got[1] == ("", "", None, "allow") and got[2] == got[3] == ("b.net", "/", "net/", "block")
    assert _judge(spark, ["x"])[0][3] == "allow"
    pages = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(pages, U.rule_table(spark, U.production_rules())).count() == 0


def test_rules_without_tokens_and_open_ended_paths(spark):
    rules = [U.pattern_rule("block", "*"), U.domain_rule("allow", "a.com/en"), U.domain_rule("block", "é/")]
    pages = spark.createDataFrame([(1, "http://a.com/english"), (2, "http://b.com"), (3, "http://x.é/")], "page_id long, url string")
    got = [(r.rule, r.verdict) for r in U.judge(pages, U.rule_table(spark, rules)).orderBy("page_id").collect()]
    assert got == [("a.com/en", "allow"), (None, "block"), ("é/", "block")]


def test_each_rule_is_filed_under_a_token_of_its_own():
    for r in U.production_rules():
        assert "" not in r.tokens
    assert U.pattern_rule("block", "*/ads/*").tokens == ("ads",)
    assert U.pattern_rule("block", "*ads*").tokens == ()
