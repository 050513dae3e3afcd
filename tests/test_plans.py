"""Shapes of plans, stream restarts and the daily run."""

import datetime as dt

from pyspark.sql import functions as F

from checks import layers as LY
from checks import warehouse as W
from checks.views import RUN_AT, offers_raw
from offermart import schemas as S
from offermart import streaming
from offermart import vocab as V
from offermart.operators import dedup, market, pages
from offermart.operators import star as S_
from offermart.plans import daily, layers
from offermart.sinks import write_layer
from offermart.sources import conform, read_gold_for_day, stream_bronze

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_runs_without_python(spark):
    text = plan(LY.gold(spark, SF))
    assert not any(node in text for node in ("EvalPython", "InPandas", "InArrow", "pythonUDF"))


def test_first_by_id_cuts_groups_before_the_shuffle(spark):
    text = plan(dedup.first_by_id(offers_raw(spark, SF)))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_greedy_rounds_stay_in_the_engine(spark):
    text = plan(dedup.greedy_unique(offers_raw(spark, SF)))
    assert not any(node in text for node in ("InPandas", "InArrow", "EvalPython", "Coalesce 1"))


def test_gold_of_a_day_prunes_partitions(spark, tmp_path):
    root = str(tmp_path / "20240205" / "gold")
    for hour in (0, 1):
        write_layer(W.gold(spark, SF).drop("ord"), root, RUN_AT + dt.timedelta(hours=hour))
    found = read_gold_for_day(spark, root, V.A, "20240201")
    assert "_source" in plan(found) and "PartitionFilters: []" not in plan(found)
    assert found.select("ord.file").distinct().where("file LIKE '%run=20240201_070000%'").count() == found.select("ord.file").distinct().count()
    assert read_gold_for_day(spark, root, V.A, "20240205").count() == 0


def test_upsert_sorts_no_texts(spark):
    assert "SortAggregate" not in plan(S_.upsert_states(W.gold(spark, SF)))


def test_upsert_shuffles_each_column_once(spark):
    text = plan(S_.upsert_states(W.gold(spark, SF)))
    assert text.count("Exchange hashpartitioning(id_offre") == 2 and text.count("Scan parquet") == 2
    assert text.count("WindowGroupLimit") == 4 and "EXECUTOR_BROADCAST" not in text


def test_history_is_not_shuffled(spark, tmp_path):
    """States of many batches merge bucket by bucket, in the session that wrote them and in one that only reads them."""
    rows, path = W.gold(spark, SF), str(tmp_path / "out")
    for part in (0, 1):
        rows.filter(F.col("ord") % 2 == part).write.parquet(str(tmp_path / "in" / str(part)))
        arriving = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        streaming.upsert(arriving, path, str(tmp_path / "state")).start().awaitTermination()
    fresh = spark.newSession()
    for name in ("states", "pairs"):
        spark.sql(f"DROP TABLE {streaming._bucketed(spark, path, name)}")  # as in an application that has not seen the folder
    for session in (fresh, spark):
        parts = streaming._history(session, path)
        for name in ("states", "pairs"):
            text = plan(parts[name])
            assert "Bucketed: true" in text and "Exchange" not in text.replace("BroadcastExchange", "")
        star = streaming.read_upserted(session, path)
        want = S_.fact_rows(S_.upsert_states(rows))
        got = star.offres.join(star.entreprises, "id_entreprise", "left").select("id_offre", "titre_clean", "nom", "recherche_text")
        known = F.when(F.col("entreprise") != V.NON_SPECIFIE, F.col("entreprise"))
        assert got.exceptAll(want.select("id_offre", "titre_clean", known, "recherche_text")).count() == 0
        assert got.count() == want.count()
        assert star.offre_competence.count() == S_.offer_skills(rows).count()


def test_description_ends_on_its_own_level(spark):
    nested = "<div class='job-description'><div>Intro</div><p>Python <DIV>et</div> SQL</p></div><div>other</div>"
    rows = [(nested,), ("<main><p>a</p><article>b<article>c</article>d</article>e</main>",), ("<article>out</article>",), (None,),
            ("<section data-testid='job-description'>never closed",)]
    df = spark.createDataFrame(rows, "html string")
    got = [r[0] for r in df.select(pages.description(F.col("html"))).collect()]
    assert got[0] == "Intro Python et SQL" and got[1] == "b c d" and got[4] == "never closed"
    assert not got[2] and not got[3]
    assert df.select(pages.description(F.col("html"), any_article=True)).collect()[2][0] == "out"


def test_recent_limits_the_fact_before_joining(spark):
    star = W.warehouse(spark, SF)
    text = plan(market.recent(star))
    assert "TakeOrderedAndProject" in text and "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text and "Cartesian" not in text


def test_gold_scan_reads_only_what_is_asked(spark):
    star = W.warehouse(spark, SF)
    text = plan(market.salary_stats(star.offres))
    assert "recherche_text" not in text and "PushedFilters: [IsNotNull(salaire_mensuel)]" in text


def test_stream_restart_adds_nothing(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = conform(offers_raw(spark, SF), S.BRONZE).filter(F.col("source") == V.F)
    rows.write.json(source)
    for _ in range(2):
        stream = streaming.refined(stream_bronze(spark, source), V.F, RUN_AT)
        streaming.to_parquet(stream, out, state).start().awaitTermination()
    assert spark.read.parquet(out).count() == rows.count()
    batch = layers.gold(rows, V.F, RUN_AT, keep=())
    assert spark.read.parquet(out).exceptAll(batch).count() == 0


def test_daily_run_tolerates_a_missing_source_and_reads_the_newest_gold(spark, tmp_path):
    root = str(tmp_path)
    rows = offers_raw(spark, SF)
    delivered = {s: rows.filter(F.col("source") == s) for s in (V.A, V.W)}
    star = daily.run_day(spark, root, RUN_AT, delivered)
    assert {r.source for r in market.by_source(star.offres).collect()} == {V.A, V.W}
    first = star.offres.count()
    again = daily.run_day(spark, root, RUN_AT + dt.timedelta(hours=1), refine_only=True)
    assert again.offres.count() == first
    assert read_gold_for_day(spark, f"{root}/gold", V.F, "20240201").count() == 0
    assert read_gold_for_day(spark, f"{root}/gold", V.A, "20240131").count() == 0
    assert read_gold_for_day(spark, f"{root}/none", V.A, "20240201").count() == 0


def test_a_killed_load_leaves_the_version_before(spark, tmp_path, monkeypatch):
    from offermart import sinks

    rows, root = W.gold(spark, SF), str(tmp_path)
    assert sinks.current_version(spark, root) is None
    sinks.publish_star(rows.filter(F.col("source") == V.A), root, "one")
    before = sinks.current_star(spark, root).offres.count()

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:  # three of the four tables are written
        m.setattr(sinks, "bridge", killed)
        try:
            sinks.publish_star(rows, root, "two")
        except RuntimeError:
            pass
    assert sinks.current_version(spark, root) == "one" and sinks.current_star(spark, root).offres.count() == before
    sinks.publish_star(rows, root, "two")
    sinks.publish_star(rows.limit(0), root, "one")  # published before: stays
    star = sinks.current_star(spark, root)
    assert sinks.current_version(spark, root) == "two" and star.offres.count() == rows.select("id").distinct().count()
    assert star.offres.join(star.offre_competence, "id_offre", "left_anti").count() == star.offres.count() - star.offre_competence.select("id_offre").distinct().count()


def test_a_day_goes_on_after_its_last_finished_stage(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows = offers_raw(spark, SF)
    delivered = {s: rows.filter(F.col("source") == s) for s in V.SOURCES}
    refined, real = [], daily.refine_source

    def refine(spark, root, source, run_at):
        refined.append(source)
        if refined == [V.A, V.F]:
            raise RuntimeError("killed")
        real(spark, root, source, run_at)

    monkeypatch.setattr(daily, "refine_source", refine)
    try:
        daily.run_day(spark, root, RUN_AT, delivered)
    except RuntimeError:
        pass
    star = daily.run_day(spark, root, RUN_AT, delivered)
    assert refined == [V.A, V.F, V.F, V.W]
    assert spark.read.json(f"{root}/bronze").count() == rows.count()
    assert star.offres.count() == W.warehouse(spark, SF).offres.count()
    again = daily.run_day(spark, root, RUN_AT, delivered)
    assert len(refined) == 4 and again.offres.count() == star.offres.count()


def test_postings_answer_like_a_scan_and_read_their_parts_only(spark, tmp_path):
    from offermart.operators import postings

    path, offers = str(tmp_path / "postings"), W.warehouse(spark, SF).offres
    postings.append_postings(offers, path, 0)
    extra = spark.createDataFrame([("x", None), ("y", ""), ("z", "Été  été c++ " + "mission " * 5000)], "id_offre string, recherche_text string")
    postings.append_postings(extra, path, 1)
    postings.append_postings(extra, path, 1)  # sent again
    everything = offers.select("id_offre", "recherche_text").unionByName(extra)
    for query in ("des Engineer avec Spark et une mission", "mission", "été", "été mission", "engineer introuvable", "c++", "le la", ""):
        got = [r[0] for r in postings.search_postings(spark, path, query).collect()]
        assert sorted(got) == sorted(r["id_offre"] for r in market.token_search(everything, query).collect()), query
    text = plan(postings.read_postings(spark, path, ["spark"]))
    assert "PartitionFilters: [" in text and "part#" in text.split("PartitionFilters: [")[1] and "In(mot" in text.replace("EqualTo(mot", "In(mot")
    assert "recherche_text" not in text


def test_replaced_skills_touch_only_their_buckets(spark, tmp_path):
    import os

    from offermart.sinks import replace_skills, replace_stored_skills, store_skills

    path = str(tmp_path / "skills")
    rows = spark.range(500).selectExpr("id % 100 AS id_utilisateur", "concat('s', id) AS nom_competence")
    store_skills(rows, path, 16)
    times = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith("parquet")}
    before = times()
    fresh = spark.createDataFrame([(3, "redis"), (3, "sql"), (500, "new")], "id_utilisateur long, nom_competence string")
    replace_stored_skills(path, fresh, 16)
    replace_stored_skills(path, fresh.limit(0), 16)
    after = times()
    stayed = {f for f in before if after.get(f) == before[f]}
    changed = {os.path.dirname(f) for f in [*before, *after] if f not in stayed}
    assert len(changed) <= 2 and len(stayed) >= len(before) - len(changed)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("id_utilisateur", "nom_competence").collect())
    assert got == sorted(tuple(r) for r in replace_skills(rows, fresh).collect())


def test_token_search_cuts_only_texts_that_hold_the_words(spark):
    found = market.token_search(W.warehouse(spark, SF).offres, "Engineer Spark")
    assert plan(found).count("Contains(lower(recherche_text") >= 2


def test_a_report_finds_its_unique_offers_once(spark):
    from offermart.plans import report

    rows = offers_raw(spark, SF).withColumn("competences", F.array(F.lit("x")))
    shown = report.collector_report(rows, dedup.greedy_unique(rows), V.F)
    assert "LeftSemi" not in plan(shown) and plan(shown).count("ExistingRDD") >= 5


def test_offers_in_order_are_sorted_before_their_texts_are_made(spark):
    from checks.views import offers_in_order

    rows = offers_in_order(spark, SF)
    orders = [r[0] for r in rows.select("ord").collect()]
    assert orders == sorted(orders) and rows.exceptAll(offers_raw(spark, SF)).count() == 0 and len(orders) == offers_raw(spark, SF).count()
    text = plan(rows)
    assert text.index("mission longue") < text.index("Sort [") and "hashpartitioning(o_orderkey" not in text


def test_dropped_offers_are_compressed(spark):
    from checks import collect

    files = spark.read.schema(S.BRONZE).json(collect._bronze_files(spark, SF)).inputFiles()
    assert files and all(f.endswith(".json.gz") for f in files)


def test_a_delivery_is_one_batch_however_many_files_it_has(spark, tmp_path, monkeypatch):
    import os

    from checks import collect

    rows = spark.range(300).selectExpr("id AS event_id", "timestamp '2024-01-01' + make_interval(0, 0, 0, id % 9) AS ts", "concat('t', id % 2) AS event_type")
    rows.repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(collect, "_fresh", lambda spark, name: str(tmp_path / name))
    spark.conf.set("spark.sql.files.openCostInBytes", "1g")  # a task, and so a file, for each file read
    try:
        counted = collect.stream_daily_totals(spark, str(tmp_path)).agg(F.sum("n")).first()[0]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    files = [f for _, _, names in os.walk(tmp_path / "totals" / "in") for f in names if f.endswith(".parquet")]
    batches = [d for d in os.listdir(tmp_path / "totals" / "out") if d.startswith("batch=")]
    assert counted == 300 and len(files) > 8 and len(batches) == 4


def test_an_upsert_keeps_no_texts_and_deals_them_once(spark, tmp_path, monkeypatch):
    """Only short columns of a batch are kept in memory; its rows are shuffled into their buckets, not before and once more."""
    rows, kept, plans = W.gold(spark, SF), [], []
    rows.write.parquet(str(tmp_path / "in"))
    persist, insert, width = type(rows).persist, streaming._insert, spark.conf.get("spark.sql.shuffle.partitions")

    def kept_rows(df, *level):
        kept.append(set(df.columns))
        return persist(df, *level)

    def inserted(df, path, name, batch):
        if name == "states":
            plans.append(plan(df.repartition(streaming.BUCKETS, "id_offre")))
        insert(df, path, name, batch)

    monkeypatch.setattr(type(rows), "persist", kept_rows)
    monkeypatch.setattr(streaming, "_insert", inserted)
    arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    streaming.upsert(arriving, str(tmp_path / "out"), str(tmp_path / "state")).start().awaitTermination()
    assert kept == [{"id", "entreprise", "competences"}]
    assert [p.count("Exchange hashpartitioning(id_offre") for p in plans] == [2]
    assert spark.conf.get("spark.sql.shuffle.partitions") == width
    star = streaming.read_upserted(spark, str(tmp_path / "out"))
    assert star.offres.count() == rows.select("id").distinct().count()


def test_batches_before_stay_whatever_the_session_overwrites(spark, tmp_path):
    rows, path = W.gold(spark, SF), str(tmp_path / "out")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        for part, mine in (("a", F.col("source") == V.A), ("b", F.col("source") != V.A)):
            rows.filter(mine).coalesce(1).write.parquet(str(tmp_path / "in" / part))
            arriving = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
            streaming.upsert(arriving, path, str(tmp_path / "state")).start().awaitTermination()
            first = streaming.collect_first(arriving, str(tmp_path / "first"), str(tmp_path / "seen"))
            first.start().awaitTermination()
        streaming.compact(spark, path, str(tmp_path / "compact"))
        ids = rows.select("id").distinct().count()
        for stored in (path, str(tmp_path / "compact")):
            star = streaming.read_upserted(spark, stored)
            assert star.offres.count() == ids and star.offre_competence.count() == S_.offer_skills(rows).count()
        assert streaming.read_first(spark, str(tmp_path / "first")).count() == ids
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
