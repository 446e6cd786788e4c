import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dailylake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="dailylake-tests", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="dailylake-test-ckpt-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_root(spark):
    from dailylake.session import scratch_path
    return scratch_path(spark, "test")


def envelope(dt, location_id, *, date=None, ingested_at="2024-03-01T06:00:00+00:00",
             temp_avg="10.5", temp_min="5.0", temp_max="15.0", precip="1.2", snow="0",
             humidity="70", wind="12.5", code="1000", text="Sunny", name=None, country="RO",
             lat="44.4", lon="26.1", tz="Europe/Bucharest", local_time="2024-03-01 08:00",
             forecast=True):
    """One bronze record as an ingestion client writes it (numbers as JSON numbers)."""
    def num(v):
        if v is None:
            return None
        try:
            return float(v)
        except (TypeError, ValueError):
            return v
    rec = {
        "metadata": {"dt": dt, "location_id": location_id, "location_name": name or location_id,
                     "ingested_at": ingested_at, "source": "api", "api_version": "v1",
                     "request": {"q": f"{lat},{lon}", "endpoint": "history.json"}},
        "payload": {"location": {"name": name or location_id, "region": "R", "country": country,
                                 "lat": num(lat), "lon": num(lon), "tz_id": tz,
                                 "local_time": local_time}},
    }
    if forecast:
        rec["payload"]["forecast"] = {"forecastday": [{
            "date": date or dt,
            "day": {"mintemp_c": num(temp_min), "maxtemp_c": num(temp_max),
                    "avgtemp_c": num(temp_avg), "totalprecip_mm": num(precip),
                    "totalsnow_cm": num(snow), "avghumidity": num(humidity),
                    "maxwind_kph": num(wind), "condition": {"code": num(code), "text": text}}}]}
    else:
        rec["payload"]["forecast"] = {"forecastday": []}
    return rec


def land(root, dt, folder, rec, name="raw.json"):
    """Write one landed, pretty-printed bronze file dt=<dt>/location_id=<folder>/raw.json."""
    d = os.path.join(root, f"dt={dt}", f"location_id={folder}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        if isinstance(rec, str):
            f.write(rec)
        else:
            json.dump(rec, f, ensure_ascii=False, indent=2)


@pytest.fixture
def landed(tmp_root):
    root = os.path.join(tmp_root, "bronze")
    os.makedirs(root, exist_ok=True)
    return root
