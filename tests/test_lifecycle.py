"""The dashboard's data paths end to end, as a user would wire them."""

import json
import os

from storepulse.operators import dau_total, new_devices, order_total, realtime_hour, realtime_total
from storepulse.schemas import STARTUP
from storepulse.sources import log_stream, topic_stream
from storepulse.streaming import (DAU_TABLE, cdc_stream_to_orders, collect_logs, dau_stream, order_stream,
                                  read_orders, run_to_end)

T0 = 1551657600000  # 2019-03-04 00:00 UTC


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_logs_to_dau_kpis(spark, tmp_dir):
    raw = []
    for i, (mid, hour, day) in enumerate([("m1", 9, 0), ("m1", 10, 0), ("m2", 9, 0), ("m3", 23, -1), ("m1", 1, 1)]):
        ts = T0 + day * 86_400_000 + hour * 3_600_000 + i
        raw.append(json.dumps({"type": "startup", "mid": mid, "uid": "1", "area": "a", "ts": ts, "log_id": i}))
    raw.append(json.dumps({"type": "event", "mid": "m1", "evid": "clickItem", "itemid": 3}))
    _write(f"{tmp_dir}/raw", "a.json", raw)
    # collector: replaying stamped logs keeps their ts
    run_to_end(collect_logs(log_stream(spark, f"{tmp_dir}/raw"), f"{tmp_dir}/bus", f"{tmp_dir}/ck1",
                            trigger="availableNow", now="client", tz="UTC"))
    startup_topic = f"{tmp_dir}/bus/topics/topic=startup"
    run_to_end(dau_stream(log_stream(spark, startup_topic), f"{tmp_dir}/dau", f"{tmp_dir}/ck2",
                          trigger="availableNow", tz="UTC"))
    dau = spark.read.schema(DAU_TABLE).parquet(f"{tmp_dir}/dau")
    assert dau_total(dau, "2019-03-04").first().total == 2
    cmp = {r.hour: (r.yesterday, r.today) for r in realtime_hour(spark, "dau", "2019-03-04", dau=dau).collect()}
    assert cmp["09"] == (0, 2) and cmp["23"] == (1, 0) and len(cmp) == 24
    assert {r.log_date: r.n for r in new_devices(dau).collect()} == {"2019-03-03": 1, "2019-03-04": 2}


def test_changes_to_order_kpis(spark, tmp_dir):
    def env(typ, rows):
        return json.dumps({"entry_type": "ROWDATA", "table": "order_info", "type": typ,
                           "rows": [[{"name": k, "value": v} for k, v in r.items()] for r in rows]})
    o1 = {"id": "1", "area": "north", "total_amount": "10.10", "consignee_tel": "13812345678",
          "create_time": "2019-03-04 09:10:11"}
    o2 = dict(o1, id="2", total_amount="0.20", create_time="2019-03-04 10:00:00")
    o3 = dict(o1, id="3", total_amount="5.00", create_time="2019-03-03 09:59:59")
    _write(f"{tmp_dir}/cdc", "a.json", [env("INSERT", [o1, o2]), env("INSERT", [o3]), env("UPDATE", [o1])])
    run_to_end(cdc_stream_to_orders(spark, f"{tmp_dir}/cdc", f"{tmp_dir}/bus", f"{tmp_dir}/ck1", trigger="availableNow"))
    run_to_end(order_stream(topic_stream(spark, f"{tmp_dir}/bus/order"), f"{tmp_dir}/orders", f"{tmp_dir}/ck2",
                            trigger="availableNow"))
    orders = read_orders(spark, f"{tmp_dir}/orders")
    assert order_total(orders, "2019-03-04").first().total == 10.3
    cmp = {r.hour: (r.yesterday, r.today) for r in
           realtime_hour(spark, "order_amount", "2019-03-04", orders=orders).collect()}
    assert cmp["09"] == (5.0, 10.1) and cmp["10"] == (0.0, 0.2)
    assert set(r.consignee_tel for r in orders.collect()) == {"*******5678"}
    empty_dau = spark.createDataFrame([], STARTUP)
    cards = {c.id: c.value for c in realtime_total(empty_dau, empty_dau, orders, "2019-03-04").collect()}
    assert cards == {"dau": 0.0, "new_mid": 0.0, "order_amount": 10.3}
