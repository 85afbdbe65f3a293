"""Fixed parameters of the registered queries.

The reference's demos use second-sized windows; the test tables span 30 days,
so durations are scaled (values fixed here, used by both the Spark side and
the SQL oracle).
"""

TUMBLE = "1 day"
SLIDE_SIZE = "1 day"
SLIDE_STEP = "12 hours"
SESSION_GAP = "6 hours"
LATE_WINDOW = "1 hour"
WATERMARK_DELAY_S = 3 * 3600          # default bounded disorder (3 h)
WATERMARK_DELAY_STRESS_S = 3600       # stress case (1 h)
COUNT_SIZE = 10
COUNT_SLIDE = 3
JUMP = 100                            # ST01 alert threshold on |vc - prev|
SIDE_ALERT = 10                       # SP03 / P08 threshold (vc > 10)
TTL_S = 6 * 3600                      # ST06 state time-to-live on arrival
INTERVAL_S = 2 * 3600                 # J02 interval join +-2 h
JOIN_WINDOW = "1 day"                 # J01 window join
TOP_N = 2
PARTITIONS = 4                        # R01-R04 fan-out
IDLE_S = 5 * 3600                     # T04 source idleness bound
INACTIVITY_S = 24 * 3600              # ST11 inactivity alert
TIMER_DELAY_S = 3600                  # ST09 timer at et + 1 h

# The reference's sensor ids sensor_1 / sensor_2 map to user ids 1 / 2.
SENSOR_1 = 1
SENSOR_2 = 2
