from traitlens.llm import url_filter as U


def test_verdicts(spark):
    urls = ["http://x.net/", "http://net", "http://WWW.Example.NET/en/a?b", "http://example.net/en", "ftp://a.example.com/de/1",
            "http://org/fr/", "http://a.org/fr", "net/", None, "", "http://", "http://notnet/", "a://b://c.net/x",
            "http://h?q=/", "http://h#f/", "http://h/a#b?c", "http://h/é/x", "http://x.net/"]
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)] + [(None, "http://x.net/", "", "")],
                                  "page_id long, url string, rule string, host string")
    rules = spark.createDataFrame(U.RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.url_filter(pages, rules).collect()}
    assert len(got) == len(urls) + 1 and got[None] == got[0] == got[17] == ("x.net", "/", "net/", "block")
    assert got[1] == ("net", "", None, "allow")
    assert got[2] == ("www.example.net", "/en/a", "example.net/en/", "allow")
    assert got[3] == ("example.net", "/en", "net/", "block")
    assert got[4][2:] == ("example.com/de/", "block") and got[5][2:] == ("org/fr/", "allow") and got[6][2] is None
    assert got[7] == got[8] == got[9] == got[10] == ("", "", None, "allow")
    assert got[11][2] is None and got[12] == ("b:", "//c.net/x", None, "allow")
    assert got[13] == ("h", "", None, "allow") and got[14][:2] == ("h", "") and got[15][:2] == ("h", "/a")
    assert U.url_filter(pages.where("false"), rules).count() == 0
    assert {r.verdict for r in U.url_filter(pages, rules.where("false")).collect()} == {"allow"}


def test_ties_and_short_prefixes(spark):
    pages = spark.createDataFrame([(1, "http://a.b.c/x/y")], "page_id long, url string")
    rules = spark.createDataFrame([("b.c", "/", "allow"), ("c", "/x/", "block"), ("b.c", "/", "block"), (None, "/", "block"),
                                   ("c", "/x", "allow")], "host string, path string, verdict string")
    full = U.judge(pages, rules).first()
    assert (full.rule, full.verdict) == ("b.c/", "block")  # of the longest, the longer host, then block
    assert U.judge(pages, rules, digits=1).first() == full  # collisions of prefixes are told apart by the digest
