import os
import random
import time
from collections import Counter
from datetime import datetime, timezone

import pytest

from clickloom.operators import ads
from clickloom.session import new_folder, shared_table
from clickloom.sources.ad_log import file_lines
from clickloom.streaming.ad_clicks import AdClickJob

BASE = int(datetime(2024, 3, 1, 12, tzinfo=timezone.utc).timestamp() * 1000)
ONCE = {"availableNow": True}


def line(seconds=0, province="P", city="C", user=1, ad=1):
    return f"{BASE + seconds * 1000} {province} {city} {user} {ad}"


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def content(df):
    return sorted(tuple(str(v) if i == 0 else v for i, v in enumerate(r)) for r in df.collect())


def test_malformed_lines_are_set_aside(spark):
    bad = ["", "x P C 1 1", f"{BASE} P C one 1", f"{BASE} P C 1", "junk"]
    log = lines(spark, line(), *bad)
    assert ads.parse_ad_log(log).count() == 1
    assert sorted(r.value for r in ads.malformed_ad_log(log).collect()) == sorted(bad)
    click = ads.parse_ad_log(log).first()
    assert (str(click.date), click.province, click.city, click.user_id, click.ad_id) == ("2024-03-01", "P", "C", 1, 1)


def test_blacklist_by_broadcast_and_by_shuffle(spark, shuffle_only):
    clicks = ads.parse_ad_log(lines(spark, *[line(i, user=1 if i % 3 == 0 else i) for i in range(300)]))
    barred = shared_table(spark.createDataFrame([(1,), (5,), (5,), (900,)], "user_id bigint"), "barred")
    small = ads.without_blacklisted(clicks, barred)
    assert small.count() == 198 and small.columns == clicks.columns  # of 1 to 299, user 5 clicked once, 1 on its own once
    shuffle_only()
    assert sorted(map(repr, ads.without_blacklisted(clicks, barred).collect())) == sorted(map(repr, small.collect()))


def test_province_ranking_is_per_day_and_breaks_ties_by_id(spark):
    data = [line(0, "P", c, ad=a) for c, a, n in (("C", 1, 2), ("D", 1, 1), ("C", 2, 2), ("C", 9, 2), ("C", 4, 1)) for _ in range(n)]
    data += [line(86_400, "P", ad=4), line(0, "Q", ad=4)]
    top = ads.province_top_ads(ads.ad_totals(ads.parse_ad_log(lines(spark, *data))))
    assert content(top) == [
        ("2024-03-01", "P", 1, 3), ("2024-03-01", "P", 2, 2), ("2024-03-01", "P", 9, 2),
        ("2024-03-01", "Q", 4, 1), ("2024-03-02", "P", 4, 1)]


def test_trailing_hour(spark):
    data = [line(0), line(59), line(61), line(3600), line(3601), line(3660)]
    minutes = ads.minute_clicks(ads.parse_ad_log(lines(spark, *data)))
    assert sorted(r.click_count for r in minutes.collect()) == [1, 1, 2, 2]
    assert sorted(r.click_count for r in ads.trailing_minutes(minutes).collect()) == [1, 2]
    trend = sorted(tuple(r)[1:] for r in ads.click_trend(minutes).collect())
    assert trend[0] == ("12", "00", 1, 2)


def test_sliding_windows_against_brute_force(spark):
    rng = random.Random(3)
    seconds = [(rng.randrange(200), rng.randrange(2)) for _ in range(60)]
    clicks = ads.parse_ad_log(lines(spark, *[line(s, ad=a) for s, a in seconds]))
    want = Counter()
    for s, a in seconds:
        for start in range(s - s % 10 - 50, s + 1, 10):
            want[start, a] += 1
    got = {
        (int(r.window_start.replace(tzinfo=timezone.utc).timestamp()) - BASE // 1000, r.ad_id): r.click_count
        for r in ads.sliding_clicks(clicks, "60 seconds", "10 seconds").collect()
    }
    assert got == want


# --- streams -------------------------------------------------------------------------------------


class Feed:
    """A folder of text files that is read as the ad log, one file per micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.written = spark, folder, []
        self.created = time.time() - 1000
        folder.mkdir()

    def add(self, *values):
        path = self.folder / f"{len(self.written):04d}.txt"
        path.write_text("\n".join(values) + "\n")
        # Files are taken in the order of their times, which must not tie.
        moment = self.created + len(self.written)
        os.utime(path, (moment, moment))
        self.written.append(values)

    def stream(self):
        return file_lines(self.spark, str(self.folder), 1)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "log")


def job(spark, **settings):
    return AdClickJob(root=new_folder(spark, "job"), **{"trigger": ONCE, "threshold": 3, **settings})


def run(spark, feed, j):
    j.filter_clicks(feed.stream()).awaitTermination()
    j.running_totals(j.clean_clicks(spark, 1)).awaitTermination()
    j.click_trends(feed.stream()).awaitTermination()


def expected(batches, threshold, seed=()):
    """Batch by batch: filter, count, extend the blacklist."""
    barred, users, stat, trend = set(seed), Counter(), Counter(), Counter()
    for batch in batches:
        parsed = [v.split(" ") for v in batch]
        for t, _, _, _, ad in parsed:
            trend[datetime.fromtimestamp(int(t) // 1000, timezone.utc).strftime("%Y-%m-%d %H %M"), int(ad)] += 1
        clean = [p for p in parsed if int(p[3]) not in barred]
        for t, province, city, user, ad in clean:
            day = str(datetime.fromtimestamp(int(t) // 1000, timezone.utc).date())
            users[day, int(user), int(ad)] += 1
            stat[day, province, city, int(ad)] += 1
        barred |= {user for (_, user, _), n in users.items() if n >= threshold}
    return barred, users, stat, trend


def check(spark, feed, j, seed=()):
    barred, users, stat, trend = expected(feed.written, j.threshold, seed)
    assert sorted(r.user_id for r in j.blacklisted(spark).collect()) == sorted(barred)
    assert content(j.user_clicks.read(spark)) == sorted((*k, n) for k, n in users.items())
    assert content(j.stat.read(spark)) == sorted((*k, n) for k, n in stat.items())
    got = {(f"{r.date} {r.hour} {r.minute}", r.ad_id): r.click_count for r in j.trend.read(spark).collect()}
    assert got == trend
    provinces = Counter()
    for (day, province, _, ad), n in stat.items():
        provinces[day, province, ad] += n
    groups = {}
    for (day, province, ad), n in provinces.items():
        groups.setdefault((day, province), []).append((-n, ad))
    top = sorted((*g, ad, -n) for g, found in groups.items() for n, ad in sorted(found)[:3])
    assert content(j.province_top.read(spark)) == top


def random_lines(rng, count, users=6):
    return [
        line(rng.randrange(200_000), f"P{rng.randrange(2)}", f"C{rng.randrange(2)}", rng.randrange(users), rng.randrange(5))
        for _ in range(count)
    ]


def test_stream_of_batches_with_restart(spark, feed):
    rng = random.Random(11)
    j = job(spark, keep=1)
    feed.add(*random_lines(rng, 25))
    feed.add(*random_lines(rng, 25))
    run(spark, feed, j)
    check(spark, feed, j)
    feed.add(*random_lines(rng, 40))
    run(spark, feed, j)  # resumes from the checkpoints
    check(spark, feed, j)
    run(spark, feed, j)  # nothing new
    check(spark, feed, j)


def test_blacklisted_user_is_dropped_from_the_next_batch(spark, feed):
    j = job(spark)
    j.bar_users(spark.createDataFrame([(8,)], "user_id bigint"))
    feed.add(*[line(user=5)] * 3, line(user=6), line(user=8))
    feed.add(line(user=5), line(user=6))
    run(spark, feed, j)
    check(spark, feed, j, seed=[8])
    assert sorted(r.user_id for r in j.blacklisted(spark).collect()) == [5, 8]
    assert content(j.user_clicks.read(spark)) == [("2024-03-01", 5, 1, 3), ("2024-03-01", 6, 1, 2)]


def test_count_reaches_the_threshold_over_several_batches(spark, feed):
    j = job(spark)
    for _ in range(3):
        feed.add(line(user=5))
    feed.add(line(user=5))
    run(spark, feed, j)
    check(spark, feed, j)
    assert content(j.user_clicks.read(spark)) == [("2024-03-01", 5, 1, 3)]


def test_users_barred_while_the_job_runs_are_dropped_from_the_next_batch(spark):
    j = job(spark)
    j.filter_batch(lines(spark, line(user=5), line(user=6)), 0)
    j.bar_users(spark.createDataFrame([(6,)], "user_id bigint"))
    j.filter_batch(lines(spark, line(user=5), line(user=6)), 1)
    assert content(j.user_clicks.read(spark)) == [("2024-03-01", 5, 1, 2), ("2024-03-01", 6, 1, 1)]


def test_state_is_let_go_after_the_lateness(spark, feed):
    for day in range(5):
        feed.add(*[line(day * 86_400 + i * 60, user=i, ad=i) for i in range(6)])
    kept = {}
    for lateness in (None, "1 hour"):
        j = job(spark, lateness=lateness)
        query = j.click_trends(feed.stream())
        query.awaitTermination()
        kept[lateness] = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert kept[None] == 30 and kept["1 hour"] < 15


def test_replayed_micro_batch_changes_nothing(spark):
    j = job(spark)
    batch = lines(spark, *[line(user=5)] * 3, line(user=6))
    for _ in range(2):
        j.filter_batch(batch, 0)
    j.filter_batch(lines(spark, line(user=5), line(user=6)), 1)
    assert content(j.user_clicks.read(spark)) == [("2024-03-01", 5, 1, 3), ("2024-03-01", 6, 1, 2)]
    assert spark.read.parquet(j.clean_log).count() == 5


def test_late_clicks_are_only_left_out_when_asked(spark, feed):
    feed.add(line(0))
    # The watermark moves after a batch and applies from the one after the next.
    feed.add(line(10 * 86_400))
    feed.add(line(10 * 86_400))
    feed.add(line(60), line(10 * 86_400 + 1))
    unbounded, bounded = job(spark), job(spark, lateness="1 day")
    for j in (unbounded, bounded):
        run(spark, feed, j)
    check(spark, feed, unbounded)
    assert sum(r.click_count for r in bounded.stat.read(spark).collect()) == 4


def test_start_runs_all_three_queries(spark, feed):
    feed.add(line(0), line(1))
    j = job(spark)
    for _ in range(2):  # the totals query may look before the clean log has its first batch
        for query in j.start(feed.stream()):
            query.awaitTermination()
    check(spark, feed, j)


def test_times_out_of_range_are_malformed(spark):
    bad = ["9223372036854775807 P C 1 1", "-5 P C 1 1", "x P C 1 1"]
    frame = lines(spark, *bad, line(0))
    assert ads.parse_ad_log(frame).count() == 1
    assert sorted(x.value for x in ads.malformed_ad_log(frame).collect()) == sorted(bad)


def test_once_gives_totals_of_all_clicks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([*(line(i, "P", "C", i, 3) for i in range(50)), "broken"]))
    job = AdClickJob(str(tmp_path / "job"), trigger={"availableNow": True})
    job.run(file_lines(spark, str(tmp_path / "in")), once=True)
    assert sum(x.click_count for x in job.stat.read(spark).collect()) == 50
    malformed = spark.read.parquet(str(tmp_path / "job" / "malformed-log"))
    assert [x.value for x in malformed.collect()] == ["broken"]
