"""The hand-written feeds of FIXTURES.md section 4."""

import os

LENTA = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel><title>lenta</title>
<item><guid>http://a/1</guid><title>A1 &amp; co</title><description><![CDATA[first]]></description>
  <pubDate>Sun, 20 Aug 2023 23:30:00 +0300</pubDate><category>Economy / World</category></item>
<item><guid>http://a/2</guid><title>A2</title><pubDate>Mon, 21 Aug 2023 01:00:00 +0300</pubDate>
  <category>Sport</category><category>World</category></item>
<item><guid>http://a/3</guid><title>A3</title><description>x</description>
  <pubDate>Mon, 21 Aug 2023 10:00:00 GMT</pubDate><category>Sport</category></item>
<item><guid>http://a/4</guid><title>A4</title><pubDate>Mon, 21 Aug 2023 11:00:00 +0300</pubDate></item>
</channel></rss>
"""

TASS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel><title>tass</title>
<item><guid isPermaLink="false">http://a/1</guid><title>dup of A1</title>
  <pubDate>Mon, 21 Aug 2023 09:00:00 +0300</pubDate><category>Politics</category></item>
<item><title>no guid 1</title><pubDate>Tue, 22 Aug 2023 09:00:00 +0300</pubDate><category>Economy</category></item>
<item><title>no guid 2</title><pubDate>Tue, 22 Aug 2023 09:30:00 +0300</pubDate><category>World</category></item>
</channel></rss>
"""


def write_landing(root, feeds: dict[str, str] | None = None) -> str:
    landing = os.path.join(str(root), "landing")
    for source, text in (feeds or {"lenta_ru": LENTA, "tass_ru": TASS}).items():
        os.makedirs(os.path.join(landing, source), exist_ok=True)
        with open(os.path.join(landing, source, f"{source}.xml"), "w", encoding="utf-8") as f:
            f.write(text)
    return landing
