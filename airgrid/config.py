"""Fixed values of the forecast job. Results are only right if these stay as they are."""

CHANNELS = [
    "2х2", "5 канал", "Домашний", "Звезда", "Канал Дисней", "Карусель", "Матч ТВ", "Муз ТВ",
    "НТВ", "Первый", "Пятница", "РЕН ТВ", "Россия 1", "Россия 24", "СТС", "СТС ЛАВ",
    "ТВ Центр", "ТВ3", "ТНТ", "ТНТ4", "Че", "Ю",
]
EXCLUDED_CHANNELS = ["Канал Дисней", "Муз ТВ"]

DAY_NUMBERS = {
    "Monday": 1, "Tuesday": 2, "Wednesday": 3, "Thursday": 4, "Friday": 5, "Saturday": 6, "Sunday": 7,
}
WEEKEND_DAY_KEYS = [3, 4]

HISTORY_FLOOR = 20170110
LOOKBACK_DAYS = 98
STEP_DAYS = 14
LAST_HORIZON_DAYS = 365
WEEK_DAYS = 7
MONTH_DAYS = 31
ACTUALS_LAG_DAYS = 3

SLOT_SECONDS = 1800
SLOTS_PER_DAY = 48

TRIM_SIGMAS = 3
FEATURES = [
    "average_grp", "average_grp_week", "average_grp_month", "average_grp_line_prg",
    "isprime", "blocknumber", "Series_diff", "Movies_diff",
]
LABEL = "factratebase"

SGD_MAX_ITER = 1000
SGD_RATE = 10.0
SGD_MIN_STEP = 1e-8
SGD_UNDERSHOOT_PENALTY = 0.9

BOOSTING_ITERATIONS = [5, 10]
BOOSTING_DEPTHS = [5, 6, 7, 8, 9, 10]
