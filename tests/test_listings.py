"""Fields of saved pages: odd texts, and long runs without a sign."""

import time

from entitymill.sources.listings import page_record


def test_page_records(spark):
    long = "word " * 60_000
    html = ["<p>a, b, Salem, OR 97301, Reno, NV 89501 3.5 miles</p>", "<p>, OR 97301 Reno! x , TX 75001</p>",
            "<p\n>  Gold\n Dealer<b>x</b>, ABC 12345, AZ 850011 <", None, "", long, long + ", OR 97301",
            "<h1> A </h1><script>, OR 97301</script> (503) 555-0100"]
    pages = spark.createDataFrame([(i, "https://www.a.com/x", h) for i, h in enumerate(html)],
                                  "page_id long, url string, html string")
    begin = time.time()
    rows = sorted(page_record(pages).select("page_id", "city", "state", "zip", "miles", "tier", "phone").collect())
    assert time.time() - begin < 60  # the square of 300,000 characters takes minutes
    tier = "Certified Installer"
    assert [tuple(r)[1:] for r in rows] == [
        ("Salem", "OR", "97301", 3.5, tier, None), ("x", "TX", "75001", None, tier, None),
        ("ABC 12345", "AZ", "85001", None, "Gold Dealer", None), (None, None, None, None, tier, None),
        (None, None, None, None, tier, None), (None, None, None, None, tier, None),
        (long.strip(), "OR", "97301", None, tier, None), (None, None, None, None, tier, "(503) 555-0100")]
