from pyspark.sql import functions as F

from broadsheet import constants as C
from broadsheet.catalog import QUERIES, load_all
from broadsheet.operators import filters, monitor, pages, rules, tasks, topk
from broadsheet.plans import audits, queue

GOOD = "강아지의 관절 건강을 오래 살펴본 연구 결과가 새로 공개되어 여러 동물병원이 참고하고 있습니다."


def item(spark, **values):
    base = {
        "id": "a", "title": "강아지 관절 건강 연구가 공개됐습니다", "lead": GOOD * 6, "paragraphs": [GOOD * 3 + str(i) + "번째 문단입니다." for i in range(4)], "source_url": "https://e.example.com/a",
        "source_label": "E", "radar_clinical": "참고할 내용입니다.", "content_tier": "analysis", "clinical_risk": "low", "workflow_status": "approved", "duplicate_status": "unique", "source_status": "verified",
    }
    row = {**base, **values}
    schema = ", ".join(f"{k} {rules.ITEM_COLUMNS[k]}" for k in row)
    return rules.prepare(spark.createDataFrame([tuple(row.values())], schema))


def codes(spark, col, **values):
    return item(spark, **values).select(col.alias("x")).first().x


def test_good_analysis_has_no_issue(spark):
    assert codes(spark, rules.quality_issues()) == []


def test_quality_codes(spark):
    assert "title-missing" in codes(spark, rules.quality_issues(), title=" ")
    assert "foreign-script" in codes(spark, rules.quality_issues(), title="강아지 漢字 소식입니다")
    assert "banned-term" in codes(spark, rules.quality_issues(), lead=GOOD + " 원-health 소식입니다.")
    assert "untranslated-term" in codes(spark, rules.quality_issues(), lead=GOOD + " owner 소식입니다.")
    assert "repeated-word" in codes(spark, rules.quality_issues(), lead="강아지 강아지 소식입니다.")
    assert "duplicate-paragraph" in codes(spark, rules.quality_issues(), paragraphs=[GOOD, GOOD, GOOD])
    assert codes(spark, rules.quality_issues(), content_tier="brief", title="짧다", lead="작다") == ["brief-title-too-short", "brief-too-short"]
    assert "source-relay" in codes(spark, rules.quality_issues(), source_url="https://news.google.com/rss/articles/x")


def test_tier(spark):
    assert codes(spark, rules.content_tier(), content_tier=None) == "analysis"
    assert codes(spark, rules.content_tier(), content_tier=None, radar_clinical=None) == "brief"
    assert codes(spark, rules.content_tier(), content_tier=None, tier="Brief") == "brief"
    assert codes(spark, rules.content_tier(), content_tier=None, doi="10.1234/x") == "evidence"


def test_risk_and_roles(spark):
    assert codes(spark, rules.clinical_risk(), clinical_risk=None, title="새 약물 용량 소식") == "high"
    assert codes(spark, rules.required_role(), clinical_risk="medium", title="진단 권고") == "vet"
    assert codes(spark, rules.required_role(), clinical_risk="medium") == "editor"
    assert codes(spark, rules.safety_issues(), lead="이 약은 완치 효과") == ["완치"]
    assert codes(spark, rules.workflow_issues()) == ["editor-review-missing"]


def test_review_gate_follows_the_policy_date(spark):
    import datetime

    old, new = datetime.datetime(2026, 7, 29), datetime.datetime(2026, 7, 30)
    assert codes(spark, rules.review_issues(), clinical_risk="high", published_at=old) == []
    assert codes(spark, rules.review_issues(), clinical_risk="high", published_at=new) == ["high-risk-vet-review-unavailable", "high-risk-not-vet-reviewed"]
    assert codes(spark, rules.review_issues(), clinical_risk="medium", published_at=new) == ["medium-risk-not-editor-reviewed"]


def test_index_decision(spark):
    publish = rules.publish_issues()
    assert codes(spark, rules.indexable(publish))
    assert not codes(spark, rules.indexable(publish), visibility="suppressed")
    assert not codes(spark, rules.indexable(publish), publication_status="public-brief")
    assert codes(spark, rules.indexable(publish), publication_status="index-low-risk")
    assert "index-low-risk-requires-low" in codes(spark, publish, publication_status="index-low-risk", clinical_risk="medium")


def test_numeric_consistency(spark):
    assert codes(spark, rules.item_numeric_issues(), lead="환자 12마리", paragraphs=["12마리 중"]) == []
    assert codes(spark, rules.item_numeric_issues(), lead="환자 13마리", paragraphs=["12마리 중"]) == ["numeric-lead-body-mismatch"]


def test_claims_and_language(spark):
    assert codes(spark, rules.claim_warnings(), species=["개"], species_studied="고양이, 말") == ["species-mismatch"]
    assert codes(spark, rules.claim_warnings(), study_type="Case report", lead="모든 환자") == ["case-report-generalization"]
    assert codes(spark, rules.language_warnings(), title="The study of 강아지") == ["untranslated-title"]
    assert codes(spark, rules.superlative(), lead="세계 최초") == ["superlative"]


def test_release(spark):
    ok = rules.release_evaluation(F.lit(True))
    assert codes(spark, ok).status == "ready-public-brief" and codes(spark, ok).grade == "index-low-risk"
    brief = codes(spark, ok, content_tier="brief", lead=GOOD * 6)
    assert (brief.status, brief.grade) == ("ready-public-brief", "index-news")
    assert codes(spark, ok, duplicate_status="update-of-existing").status == "duplicate"
    assert codes(spark, rules.release_evaluation(F.lit(False))).status == "needs-source-fix"
    assert codes(spark, ok, clinical_risk="high").status == "rejected"
    assert "image-rights" in codes(spark, ok, image_url="https://i.example.com/a.png").blockers


def test_images(spark):
    assert codes(spark, rules.image_issues(), image_url="http://i.example.com/a.png") == ["image-ownership-unknown", "image-http"]
    assert codes(spark, rules.image_renderable(), image_url="https://i.example.com/a.png", image_ownership="Licensed")
    assert not codes(spark, rules.image_renderable(), image_url="https://i.example.com/a.png")
    assert codes(spark, rules.image_renderable(), image_url="/local.png")


def test_update_classes(spark):
    def cls(match, verified, same, numbers, score, body):
        c = rules.update_class(F.lit(match), F.lit(verified), F.lit(same), F.lit(numbers), F.lit(score), rules.matches(F.lit(body), C.CORRECTION_WORDS))
        return spark.range(1).select(c.alias("x")).first().x

    assert cls(False, True, False, False, 0.0, "") == "separate-story"
    assert cls(True, True, True, True, 0.95, "") == "duplicate"
    assert cls(True, True, True, True, 0.8, "") == "minor-update"
    assert cls(True, True, True, False, 0.8, "Erratum") == "correction"
    assert cls(True, True, True, False, 0.8, "x") == "substantive-update"
    assert cls(True, True, False, False, 0.8, "x") == "unresolved"


def test_freshness(spark):
    def fresh(label, items, declared, **kw):
        c = monitor.freshness(F.lit(label), F.lit("2024-01-10"), F.lit(items), F.lit(declared), **kw)
        return spark.range(1).select(c.alias("x")).first().x

    assert fresh("2024-01-09", 5, 5) == []
    assert fresh("2024-01-01", 5, 6) == ["latest-stale", "latest-count-mismatch"]
    assert fresh("2024-01-11", 0, None) == ["latest-date-in-future", "latest-empty"]
    assert fresh("2024-02-30", None, None) == ["latest-date-invalid", "latest-items-invalid"]
    assert fresh("2024-01-09", 5, 5, require_today=True, minimum=9) == ["latest-not-today", "latest-below-minimum"]


def test_topics(spark):
    hits = topk.topic_hits(F.col("t"), F.col("b"))
    df = spark.createDataFrame([("강아지 피부 아토피 종양", ""), ("소식", "심장 심장"), ("소식", "심장")], "t string, b string")
    assert [r.x for r in df.select(topk.best_topics(hits).alias("x")).collect()] == [["피부-귀", "종양"], ["심장"], []]


def test_page_contract(spark):
    url = "https://e.example.com/article/1"
    page = f"""<title>A long enough title</title><meta name="description" content="{'d' * 40}"><link rel="canonical" href="{url}"><meta property="og:url" content="{url}">
      <meta property="og:title" content="t"><meta property="og:description" content="d"><meta property="og:image" content="i"><h1>x</h1>
      <script type="application/ld+json">[{{"@type":"NewsArticle","url":"{url}","headline":"h","image":"i"}}]</script>"""
    df = spark.createDataFrame([(url, page), (url, page.replace("<h1>x</h1>", "").replace('"headline":"h",', ""))], "url string, html string")
    got = [r.codes for r in pages.page_contract(df).collect()]
    assert got == [[], ["h1-missing", "article-headline-missing"]]


def test_snapshots(spark):
    rows = lambda ids: spark.createDataFrame([(i,) for i in ids], "id string")
    got = {(r.reason, r.n) for r in audits.retention_guard(rows(["a", "b", "c"]), rows(["a", "a", None]), rows(["c"]), "id", F.lit(3)).collect()}
    assert got == {("current-item-key-missing", 1), ("current-duplicate-ids", 1), ("public-article-removed", 1)}


def test_work_queue_order_and_filter(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    arr = "array<string>"
    review = frame(
        [("1", None, "t1", True, "high", True, "published", None, [], [], [], False), ("2", None, "t2", False, "low", True, "correction-required", None, [], [], [], False), ("3", None, "t3", False, "low", False, "published", None, [], [], [], False)],
        f"id string, date date, title string, indexable boolean, clinical_risk string, reviewer_needed boolean, workflow_status string, reviewer_role string, quality_codes {arr}, review_codes {arr}, numeric_codes {arr}, re_review boolean",
    )
    sources = frame([("1", None, "t", "unresolved", "S")], "article_id string, date date, title string, status string, source_label string")
    images = frame([("1", "t", "pending", True, ["x"])], f"id string, title string, status string, indexable boolean, issues {arr}")
    feeds = frame([("f", "F", "failing", 500), ("g", "G", "healthy", 200)], "source_id string, source_label string, status string, http_status int")
    drafts = frame([("d", "draft", "medium", False, "S", ["w"])], f"id string, title string, clinical_risk string, published boolean, source_label string, warnings {arr}")
    findings = frame([("critical", "x")], "severity string, reason string")
    fixes = frame([("9", "fact", "open", "m"), ("8", "other", "closed", "m")], "id string, kind string, status string, message string")
    q = queue.work_queue(review, sources, images, feeds, drafts, findings, fixes)
    assert [(r.id, r.priority) for r in queue.queue_head(q).collect()] == [
        ("production:sync", 150), ("public-correction:9", 145), ("editorial:2", 140), ("source:1", 125), ("editorial:1", 115), ("image:1", 105), ("feed:f", 90), ("draft:d", 80),
    ]
    assert [r.id for r in q.where(filters.queue_filter("all", "high", "FAILING")).collect()] == ["feed:f"]
    assert set(tasks.TASK) == set(q.columns)


def test_constants_are_whole():
    assert len(C.TOPICS) == 18 and len(C.CHECKLIST) == 6 and len(C.EVIDENCE_FIELDS) == 13


def test_texts_are_searched_before_the_join(spark, tmp_path):
    """The rules look at the texts where they are read: no text is shuffled for the join with events."""
    spark.createDataFrame([(1, "One two. Three\nfour", "en", "s", 19), (None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, "view", 3.0, "2024-01-05 00:00:00")], "event_id long, user_id long, event_type string, value double, ts string").withColumn("ts", F.to_timestamp("ts")).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    load_all()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("cl1_quality_issues", "cl2_publish_issues", "cl39_first_publish_class", "jb3_repair_report"):
            df = QUERIES[name](spark, str(tmp_path))
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert 0 < plan.index("SortMergeJoin") < plan.index("ArrowEvalPython"), name  # what is below stands behind
        assert {r.doc_id: r.codes.split(",")[0] for r in QUERIES["cl1_quality_issues"](spark, str(tmp_path)).collect()} == {1: "brief-title-too-short", None: "title-missing"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
