"""Equal scores tie, and sums of confidences do not hang on their order."""

from pyspark.sql import functions as F

from fieldlens.operators import crowd, review
from fieldlens.plans import crowd_queries as CQ


def test_pose_guided_scores_tie_to_nine_places(spark):
    # 0.5 / 0.5 * 0.65 + 0.3 * 0.35 and its last bit more
    rows = [("a", 1, 1, 0.5, 0.3), ("a", 1, 2, 0.5, 0.30000000000000004)]
    got = review.pose_guided_pick(spark.createDataFrame(rows, "clip_id string, frame int, det_id long, raw_conf double, pose_support double"), ["clip_id", "frame"])
    assert got.first()["guided_pick"] == 1


def test_scores_do_not_hang_on_the_order_of_confidences(spark, monkeypatch):
    confs, seen = [0.1, 0.2, 0.3, 0.96, 0.77, 0.07], set()
    for order in (confs, confs[::-1], sorted(confs)):
        rows = [("a", 1, 0.5, float(k), 0.0, c) for k, c in enumerate(order)]
        p = spark.createDataFrame(rows, "clip_id string, sample int, ts double, yaw double, pitch double, conf double").coalesce(1)
        monkeypatch.setattr(CQ.V, "players", lambda *_: p)
        seen.add(CQ.crowd_series(spark, "").first()["score"])
    assert seen == {2.4 / 6 * 0.9}


def test_equal_warmup_chains_take_the_smaller_detections(spark):
    rows = [(pos, 10 * pos + k) for pos in range(3) for k in range(2)]
    for order in (rows, rows[::-1]):
        cand = spark.createDataFrame([("a", 0, pos, d, 5.0, 0.0, 0.5) for pos, d in order], "clip_id string, batch int, pos int, det_id long, yaw double, pitch double, conf double")
        assert crowd.warmup_chain(cand.coalesce(1)).select("path").first()["path"] == "0>10>20"


def test_half_a_circle_turns_one_way():
    from fieldlens.operators.series import rate_limit_step

    step = rate_limit_step("y", "t", 25.0)
    for target in (-137.5, -137.50000000000003, -137.49999999999997):
        assert abs(step({"y": target, "t": 30.0}, [42.5, 29.5])[0] - 30.0) < 1e-9


def test_a_pan_over_the_seam_stays_below_half_a_circle():
    from fieldlens.operators.series import deadband_step, rate_limit_step

    # -167.50000000000003 less 12.5 lies just beyond the seam, and % 360 gives 360 itself
    for step, state in ((rate_limit_step("y", "t", 25.0), [-167.50000000000003, 10.5]), (deadband_step("y", 5.0), -167.50000000000003)):
        shown, after = step({"y": 180.0, "t": 11.0}, state)
        assert shown == -180.0
