"""Fixed values that must equal the original pipeline's for right results.

Fixed values (do not change; outputs depend on them):

- class labels, in the order of the decision table:
  PERDIDO_A_OTRO_EN_CIERRE, PERDIDO_A_OTRO_FUERA_CIERRE, CHURN_TOTAL,
  RETENIDO_Y_OTROS, RETENIDO
- look-back of recent editions: 730 days (both bounds strict)
- window horizon before today's midnight: 365 days (inclusive)
- closing week: 7 days before an edition's end (inclusive)
- recurrent-customer threshold: 2 earlier editions (the filtered variant of the
  pipeline used 1; both are parameters)
- purchase time text formats: "yyyy-MM-dd HH:mm:ss.SSSSSS" then "yyyy-MM-dd HH:mm:ss"
- output date text format: "yyyy-MM-dd"
"""

CLASS_LOST_CLOSING = "PERDIDO_A_OTRO_EN_CIERRE"
CLASS_LOST_OUTSIDE = "PERDIDO_A_OTRO_FUERA_CIERRE"
CLASS_CHURN = "CHURN_TOTAL"
CLASS_RETAINED_OTHERS = "RETENIDO_Y_OTROS"
CLASS_RETAINED = "RETENIDO"

LOOKBACK_DAYS = 730
WINDOW_DAYS = 365
CLOSING_DAYS = 7
MIN_EDITIONS = 2

# Optional fraction, then no fraction; anything else is null.
PURCHASE_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]"
DATE_TEXT_PATTERN = "yyyy-MM-dd"

# Purchase flag codes (one per purchase row, disjoint).
FLAG_NONE = 0
FLAG_PRE = 1
FLAG_CLOSING = 2
