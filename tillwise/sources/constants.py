"""Small fixed relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: prefecture, latitude, longitude
PREFECTURES = [
    ("北海道", 43.0642, 141.3469),
    ("青森県", 40.8244, 140.7400),
    ("岩手県", 39.7036, 141.1527),
    ("宮城県", 38.2688, 140.8721),
    ("秋田県", 39.7186, 140.1024),
    ("山形県", 38.2405, 140.3634),
    ("福島県", 37.7503, 140.4676),
    ("茨城県", 36.3418, 140.4468),
    ("栃木県", 36.5657, 139.8836),
    ("群馬県", 36.3912, 139.0608),
    ("埼玉県", 35.8569, 139.6489),
    ("千葉県", 35.6047, 140.1233),
    ("東京都", 35.6895, 139.6917),
    ("神奈川県", 35.4478, 139.6425),
    ("新潟県", 37.9026, 139.0236),
    ("富山県", 36.6953, 137.2114),
    ("石川県", 36.5946, 136.6256),
    ("福井県", 36.0652, 136.2219),
    ("山梨県", 35.6642, 138.5684),
    ("長野県", 36.2332, 138.1810),
    ("岐阜県", 35.3912, 136.7223),
    ("静岡県", 34.9769, 138.3831),
    ("愛知県", 35.1802, 136.9066),
    ("三重県", 34.7303, 136.5086),
    ("滋賀県", 35.0045, 135.8686),
    ("京都府", 35.0214, 135.7556),
    ("大阪府", 34.6864, 135.5200),
    ("兵庫県", 34.6913, 135.1830),
    ("奈良県", 34.6851, 135.8328),
    ("和歌山県", 34.2260, 135.1675),
    ("鳥取県", 35.5039, 134.2381),
    ("島根県", 35.4723, 133.0505),
    ("岡山県", 34.6618, 133.9344),
    ("広島県", 34.3966, 132.4596),
    ("山口県", 34.1861, 131.4705),
    ("徳島県", 34.0658, 134.5593),
    ("香川県", 34.3401, 134.0434),
    ("愛媛県", 33.8416, 132.7661),
    ("高知県", 33.5597, 133.5311),
    ("福岡県", 33.6064, 130.4183),
    ("佐賀県", 33.2494, 130.2998),
    ("長崎県", 32.7503, 129.8779),
    ("熊本県", 32.7898, 130.7417),
    ("大分県", 33.2382, 131.6126),
    ("宮崎県", 31.9111, 131.4239),
    ("鹿児島県", 31.5602, 130.5581),
    ("沖縄県", 26.3358, 127.8011),
]


def geo_dim(
    spark: SparkSession, rows: Sequence[tuple[str, float, float]] = PREFECTURES, key: str = "prefecture"
) -> DataFrame:
    """Place, latitude, longitude.  A literal relation, so broadcasting it is safe."""
    schema = f"{key} string, latitude double, longitude double"
    return F.broadcast(spark.createDataFrame(list(rows), schema))
