"""Report line formats (printf style, shared by Spark ``format_string`` and
the SQL oracle's ``printf``)."""

# ---- fixed values: report line formats -------------------------------------
# section titles of the Q4 and Q3 reports, in order
ANOMALY_TITLES = ("[Q4] 이상치 탐지 결과", "[아이템별 이상치 발생 빈도 Top 20]", "[요일별 이상치 발생 빈도]")
CORR_TITLES = ("[1] 카테고리별 요일-가격 상관계수", "  상관관계 강한 상위", "  상관관계 약한 하위", "[3] 요일별 카테고리 평균가")
# Q4 counts line: all rows, flagged rows
ANOMALY_COUNT_LINE = "  전체 레코드: %d건 / 이상치 탐지: %d건"
# Q4 item line: item | anomaly count | average price | average discount | minimum
ANOMALY_ITEM_LINE = "%s | 이상치 %d건 | 평균가 %d골드 | 평균할인 %.1f%% | 최저 %d골드"
# Q4 weekday line: label, weekday number, anomaly count
ANOMALY_WEEKDAY_LINE = "  %s요일(%d): %d건"
# Q3 category line: category, r, direction, strength
CORR_CATEGORY_LINE = "  %s: %s (%s %s)"
# Q3 item line: item, r, direction, row count
CORR_ITEM_LINE = "  %s: %s (%s) [%d건]"
# Q3 category × weekday average line
CATEGORY_AVG_LINE = "  %s | 요일%d | %.1f골드"
# r as fixed-point text, and the text for an undefined r
R_FORMAT, R_UNDEFINED = "%.4f", "n/a"
# ---------------------------------------------------------------------------
