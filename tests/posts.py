"""Hand-written raw posts and word tables used by several tests."""

import json

BOX = [[[-95.8, 29.5], [-95.8, 30.1]]]


def place(full_name, country_code, place_type, box=BOX):
    return {
        "full_name": full_name,
        "country_code": country_code,
        "place_type": place_type,
        "bounding_box": {"coordinates": box},
    }


def post(id, created_at, **fields):
    return {
        "id": id,
        "user": {"name": f"n{id}", "screen_name": f"s{id}", "verified": id % 2 == 0},
        "text": f"t{id}",
        "created_at": created_at,
        "truncated": False,
        "favorite_count": id * 10,
        "lang": "en",
        **fields,
    }


def without(record, *names):
    return {key: value for key, value in record.items() if key not in names}


LATE = "Wed Sep 13 23:10:00 +0000 2017"
RAW = [
    post(1, "Wed Aug 16 23:59:59 +0000 2017", place=place("Texas, USA", "US", "admin")),
    post(
        2,
        "Thu Aug 17 00:00:00 +0000 2017",
        truncated=True,
        extended_tweet={"full_text": "full2"},
        place=place("Houston, TX", "US", "city"),
    ),
    without(
        post(3, "Tue Sep 12 00:00:00 +0000 2017", place=place("Washington, DC", "US", "city")),
        "truncated",
    ),
    post(4, "Tue Sep 12 00:00:01 +0000 2017", place=place("Puerto Rico, USA", "US", "admin")),
    post(5, "Wed Sep 13 05:08:45 +0200 2017", place=place("Paris, France", "FR", "city")),
    post(6, LATE, place=place("Houston", "US", "city", [])),
    post(7, LATE, place=None, coordinates={"type": "Point", "coordinates": [-95.36, 29.76]}),
    post(8, LATE, retweeted_status={"id": 1, "text": "t1"}),
    post(9, "rubbish", place=place("Alamo Cafe", "US", "poi")),
]


def write_raw(directory):
    directory.mkdir()
    lines = [json.dumps(record) for record in RAW] + ["not json"]
    (directory / "part-0.json").write_text("\n".join(lines) + "\n")
    return str(directory)


def write_labels(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


LABEL_HEADER = "tweet\twhen\tlabel\tconfidence"
LABEL_LINES = [LABEL_HEADER] + [f"{i}\td\tlabel_{i % 2}\t0.9" for i in range(1, 10)]
