"""Small parcels, cases and regions for the tests, in the shape the sources deliver."""

from __future__ import annotations

PARCEL = (
    "seq bigint, ain_1 string, apn_1 string, situsfulladdress string, situsaddress string, damage_1 string, "
    "bsd_tag string, usedescription string, designtype1 string, sqftmain1 double, designtype2 string, "
    "sqftmain2 double, designtype3 string, sqftmain3 double, permit_status string, roe_status string, "
    "debris_cleared string, dins_count string, geometry struct<rings:array<array<array<double>>>>"
)
CASE = (
    "seq bigint, main_ain string, casenumber string, modulename string, workclass_name string, "
    "rebuild_progress_num double, apply_date double, description string, project_name string, "
    "projectname string, project_number string, status string, disaster_type string, new_dwelling_units double"
)
REGION = (
    "region_idx bigint, ct20 string, bg20 string, label string, "
    "geometry struct<rings:array<array<array<double>>>>"
)
EVENT = "Eaton Fire (01-2025)"


def names(schema):
    depth, out, word = 0, [], ""
    for c in schema + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(word.split()[0])
            word = ""
        else:
            word += c
    return out


def floats(value):
    if isinstance(value, (list, tuple)):
        return type(value)(floats(v) for v in value)
    return None if value is None else float(value)


def frame(spark, schema, rows):
    cols = names(schema)
    for row in rows:
        assert set(row) <= set(cols), set(row) - set(cols)
    rows = [{**r, "geometry": floats(r.get("geometry"))} for r in rows]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)


def square(x, y, half):
    ring = [[x - half, y - half], [x + half, y - half], [x + half, y + half], [x - half, y + half], [x - half, y - half]]
    return ([ring],)


def parcel(seq, ain, **more):
    base = {
        "seq": seq, "ain_1": ain, "damage_1": "Destroyed (>50%)", "bsd_tag": "Red", "usedescription": "Single",
        "designtype1": "0130", "sqftmain1": 1500.0,
    }
    return {**base, **more}


def case(seq, ain, **more):
    base = {
        "seq": seq, "main_ain": ain, "casenumber": f"C{seq}", "modulename": "PermitManagement",
        "workclass_name": "New", "rebuild_progress_num": 5.0, "apply_date": 1.7e12, "disaster_type": EVENT,
    }
    return {**base, **more}
