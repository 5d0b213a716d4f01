"""Labels, word lists, thresholds and dictionaries of the domain."""

# Calendar labels.
SEASON_JA = {"冬": (12, 1, 2), "春": (3, 4, 5), "夏": (6, 7, 8), "秋": (9, 10, 11)}
SEASON_EN = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Autumn": (9, 10, 11)}
SEASON_NUMBER = {4: (12, 1, 2), 1: (3, 4, 5), 2: (6, 7, 8), 3: (9, 10, 11)}
QUARTER = {1: (1, 2, 3), 2: (4, 5, 6), 3: (7, 8, 9), 4: (10, 11, 12)}
CROP_SEASON = {"春作": (3, 4, 5), "夏作": (6, 7, 8), "秋作": (9, 10, 11), "冬作": (12, 1, 2)}
FISCAL_QUARTER = {1: (4, 5, 6), 2: (7, 8, 9), 3: (10, 11, 12), 4: (1, 2, 3)}
DEMAND_CALENDAR = {"夏野菜需要期": (6, 7, 8), "冬野菜需要期": (12, 1, 2), "春端境期": (4, 5), "秋端境期": (9, 10)}
DEMAND_SEASONAL = {"夏野菜需要期": (6, 7, 8), "冬野菜需要期": (12, 1, 2), "春端境期": (4, 5), "秋端境期": (10, 11)}
DEMAND_DEFAULT = "通常期"
MONTHS_EN = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# Prefectures in matching order: search word, name, weather station, region.
PREFECTURES = (
    ("北海道", "北海道", "47412", "北海道"),
    ("青森", "青森県", "47575", "東北"),
    ("岩手", "岩手県", "47584", "東北"),
    ("宮城", "宮城県", "47590", "東北"),
    ("秋田", "秋田県", "47582", "東北"),
    ("山形", "山形県", "47588", "東北"),
    ("福島", "福島県", "47595", "東北"),
    ("茨城", "茨城県", "47629", "関東"),
    ("栃木", "栃木県", "47615", "関東"),
    ("群馬", "群馬県", "47624", "関東"),
    ("埼玉", "埼玉県", "47626", "関東"),
    ("千葉", "千葉県", "47662", "関東"),
    ("東京", "東京都", "44132", "関東"),
    ("神奈川", "神奈川県", "46106", "関東"),
    ("新潟", "新潟県", "47604", "中部"),
    ("富山", "富山県", "47607", "中部"),
    ("石川", "石川県", "47605", "中部"),
    ("福井", "福井県", "47616", "中部"),
    ("山梨", "山梨県", "47638", "中部"),
    ("長野", "長野県", "47610", "中部"),
    ("岐阜", "岐阜県", "47632", "中部"),
    ("静岡", "静岡県", "47656", "中部"),
    ("愛知", "愛知県", "47636", "中部"),
    ("三重", "三重県", "47651", "近畿"),
    ("滋賀", "滋賀県", "47761", "近畿"),
    ("京都", "京都府", "47759", "近畿"),
    ("大阪", "大阪府", "47772", "近畿"),
    ("兵庫", "兵庫県", "47770", "近畿"),
    ("奈良", "奈良県", "47780", "近畿"),
    ("和歌山", "和歌山県", "47777", "近畿"),
    ("鳥取", "鳥取県", "47744", "中国"),
    ("島根", "島根県", "47741", "中国"),
    ("岡山", "岡山県", "47768", "中国"),
    ("広島", "広島県", "47765", "中国"),
    ("山口", "山口県", "47784", "中国"),
    ("徳島", "徳島県", "47895", "四国"),
    ("香川", "香川県", "47891", "四国"),
    ("愛媛", "愛媛県", "47893", "四国"),
    ("高知", "高知県", "47898", "四国"),
    ("福岡", "福岡県", "47807", "九州・沖縄"),
    ("佐賀", "佐賀県", "47813", "九州・沖縄"),
    ("長崎", "長崎県", "47817", "九州・沖縄"),
    ("熊本", "熊本県", "47819", "九州・沖縄"),
    ("大分", "大分県", "47815", "九州・沖縄"),
    ("宮崎", "宮崎県", "47830", "九州・沖縄"),
    ("鹿児島", "鹿児島県", "47827", "九州・沖縄"),
    ("沖縄", "沖縄県", "47936", "九州・沖縄"),
)
# Two prefectures are named in English in the published location table.
PREFECTURE_AS_PUBLISHED = {"北海道": "Hokkaido", "青森県": "Aomori"}
IMPORT_WORDS = ("輸入", "外国")
IMPORTED = "輸入"
UNKNOWN = "不明"
PRIORITY_PREFECTURES = (
    "北海道", "青森県", "茨城県", "埼玉県", "千葉県", "東京都", "愛知県",
    "長野県", "静岡県", "大阪府", "広島県", "福岡県", "宮崎県", "鹿児島県",
)
SHORT_PREFECTURES = ("北海道", "青森", "茨城", "群馬", "千葉", "埼玉", "長野", "静岡", "愛知", "宮崎", "鹿児島")
SHORT_PREFECTURE_DEFAULT = "不明・その他"

# Weather stations: id, name, block of the station catalogue.
STATIONS = (
    ("47412", "札幌", "北海道"), ("47575", "青森", "東北"), ("47584", "盛岡", "東北"),
    ("47590", "仙台", "東北"), ("47582", "秋田", "東北"), ("47588", "山形", "東北"),
    ("47595", "福島", "東北"), ("47629", "水戸", "関東"), ("47615", "宇都宮", "関東"),
    ("47624", "前橋", "関東"), ("47626", "熊谷", "関東"), ("47662", "千葉", "関東"),
    ("44132", "東京", "関東"), ("46106", "横浜", "関東"), ("47604", "新潟", "中部"),
    ("47607", "富山", "中部"), ("47605", "金沢", "中部"), ("47616", "福井", "中部"),
    ("47638", "甲府", "中部"), ("47610", "長野", "中部"), ("47632", "岐阜", "中部"),
    ("47656", "静岡", "中部"), ("47636", "名古屋", "中部"), ("47651", "津", "近畿"),
    ("47761", "彦根", "近畿"), ("47759", "京都", "近畿"), ("47772", "大阪", "近畿"),
    ("47770", "神戸", "近畿"), ("47780", "奈良", "近畿"), ("47777", "和歌山", "近畿"),
    ("47744", "鳥取", "中国"), ("47741", "松江", "中国"), ("47768", "岡山", "中国"),
    ("47765", "広島", "中国"), ("47784", "下関", "中国"), ("47895", "徳島", "四国"),
    ("47891", "高松", "四国"), ("47893", "松山", "四国"), ("47898", "高知", "四国"),
    ("47807", "福岡", "九州"), ("47813", "佐賀", "九州"), ("47817", "長崎", "九州"),
    ("47819", "熊本", "九州"), ("47815", "大分", "九州"), ("47830", "宮崎", "九州"),
    ("47827", "鹿児島", "九州"), ("47936", "那覇", "沖縄"),
)
STATION_NAMES = {code: name for code, name, _ in STATIONS}
# Stations of the two smaller coverages, in order of priority.
AGRICULTURE_STATIONS = (
    "47412", "47575", "47629", "47626", "47662", "44132", "47636",
    "47610", "47656", "47772", "47765", "47807", "47830", "47827",
)
CURRENT_STATIONS = ("44132", "47772", "47636", "47807", "47412")
STATION_REGION_DEFAULT = "その他"
# Main crops around a station.
MAIN_CROPS = {
    "47412": "じゃがいも、玉ねぎ、にんじん",
    "47575": "にんにく、ごぼう、大根",
    "47629": "白菜、レタス、ピーマン",
    "47626": "ねぎ、ほうれん草、小松菜",
    "47662": "ほうれん草、ねぎ、にんじん",
    "44132": "消費地（東京市場）",
    "47636": "キャベツ、白菜、大根",
    "47610": "レタス、白菜、キャベツ",
    "47656": "レタス、白菜、大根",
    "47772": "消費地（関西圏）",
    "47765": "ほうれん草、小松菜",
    "47807": "キャベツ、ほうれん草",
    "47830": "ピーマン、きゅうり",
    "47827": "大根、白菜、ピーマン",
}

# Item words.
ITEM_CATEGORY = {
    "葉菜類": ("レタス", "キャベツ", "白菜", "ほうれん草", "小松菜", "チンゲン菜"),
    "果菜類": ("トマト", "きゅうり", "なす", "ピーマン", "かぼちゃ", "ズッキーニ"),
    "根菜類": ("大根", "にんじん", "かぶ", "ごぼう", "れんこん"),
    "芋類": ("じゃがいも", "さつまいも", "里芋", "長芋"),
    "香味野菜": ("玉ねぎ", "ねぎ", "にんにく", "しょうが"),
    "きのこ類": ("しいたけ", "えのき", "しめじ", "まいたけ"),
}
ITEM_CATEGORY_SEASONAL = {
    "葉菜類": ("レタス", "キャベツ", "白菜", "ほうれん草", "小松菜"),
    "果菜類": ("トマト", "きゅうり", "なす", "ピーマン", "かぼちゃ"),
    "根菜類": ("大根", "にんじん", "ごぼう", "玉ねぎ"),
    "芋類": ("じゃがいも", "さつまいも"),
    "香味野菜": ("ねぎ", "にんにく", "生姜"),
}
ITEM_CATEGORY_DEFAULT = "その他野菜"
ITEM_SEASON = {
    "春野菜": ("たけのこ", "アスパラ", "そら豆", "グリンピース"),
    "夏野菜": ("トマト", "きゅうり", "なす", "ピーマン", "とうもろこし", "オクラ"),
    "秋野菜": ("かぼちゃ", "さつまいも", "里芋", "れんこん"),
    "冬野菜": ("大根", "白菜", "ほうれん草", "ねぎ", "ブロッコリー"),
    "通年野菜": ("キャベツ", "レタス", "玉ねぎ", "にんじん", "じゃがいも"),
}
ITEM_SEASON_DEFAULT = "季節性不明"
ITEM_STORAGE = {
    "長期保存可": ("じゃがいも", "玉ねぎ", "にんじん", "かぼちゃ"),
    "中期保存可": ("キャベツ", "大根", "白菜"),
    "短期保存": ("レタス", "ほうれん草", "トマト", "きゅうり"),
}
ITEM_STORAGE_DEFAULT = "保存性不明"
ITEM_USAGE = {
    "サラダ・生食": ("レタス", "トマト", "きゅうり"),
    "煮物・炒め物": ("じゃがいも", "にんじん", "玉ねぎ"),
    "おひたし・炒め物": ("ほうれん草", "小松菜"),
}
ITEM_USAGE_DEFAULT = "多用途"

# Thresholds and labels, from high to low.
PRICE_TIER = ((1000, "高級品"), (500, "中級品"), (200, "一般品"))
PRICE_TIER_DEFAULT = "低価格品"
PRICE_STABILITY = ((0.5, "高変動"), (0.3, "中変動"))
VOLUME_TIER = ((1000000, "大量取引品目"), (100000, "中量取引品目"), (10000, "小量取引品目"))
VOLUME_TIER_DEFAULT = "少量取引品目"
RAIN_CLASS = ((150, "多雨"), (75, "普通"))
HEAT_CLASS = ((25, "暑い"), (15, "普通"))
WEATHER_COVER = ((25, "COMPLETE"), (15, "PARTIAL"))
SEASONALITY_LEVEL = ((0.3, "高季節性"), (0.15, "中季節性"), (0.05, "低季節性"))
VOLATILITY_LEVEL = ((0.4, "高変動"), (0.2, "中変動"), (0.1, "低変動"))
ANOMALY_STATUS = ((3, "異常値"), (2, "要注意"), (1.5, "監視対象"))
SHORT_MOVE = ((30, "急激変動"), (15, "大幅変動"), (5, "通常変動"))
ITEM_STATUS = ((2, "品目内異常"), (1, "品目内注意"))
RELIABILITY = ((0.9, "HIGH"), (0.7, "MEDIUM"), (0.5, "LOW"))
HORIZON = ((30, "SHORT_TERM"), (90, "MEDIUM_TERM"))
MAE_CONFIDENCE = ((20, 95), (50, 85), (100, 75), (200, 60))
ALERT_LEVEL = ((95, "EMERGENCY"), (80, "CRITICAL"), (60, "WARNING"))
MASE_GRADE = ((0.5, "EXCELLENT"), (0.8, "GOOD"), (1.0, "FAIR"), (1.5, "POOR"))
MODEL_TYPES = ("PROPHET", "LSTM", "ARIMA", "RANDOM_FOREST", "GRADIENT_BOOSTING", "LINEAR_REGRESSION")
MODEL_PREFERENCE = {"LSTM": 1, "PROPHET": 2, "ARIMA": 3}
MODEL_CODES = {
    "prophet": "PR", "lstm": "LS", "arima": "AR",
    "random_forest": "RF", "gradient_boosting": "GB", "linear_regression": "LR",
}
# Monthly quotas in GB.
QUOTA_GB = {"query_processing": 1024.0, "total_storage": 5.0, "table_storage": 10.0}
# Events as regressors: name, month, day, days before, days after.
CALENDAR_EVENTS = (
    ("新年", 1, 1, 0, 3),
    ("ゴールデンウィーク", 5, 1, 3, 7),
    ("お盆", 8, 15, 2, 2),
    ("年末", 12, 30, 3, 2),
)
