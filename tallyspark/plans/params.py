"""Parameters of the registered queries (literal in both the Spark plans
and the oracle SQL)."""

from tallyspark.functions.hashing import DEFAULT_PRIME, LARGE_PRIME

P = DEFAULT_PRIME
LARGE_P = LARGE_PRIME

# Text: number of salts of the two-round word counts, and the salt seed.
NUM_SALTS = 8
SALT_SEED = 7

# Graph: colours / parts, and the (a, b) hash of each run.
NUM_COLORS = 4
COLOR_RUNS = [(17, 23), (4001, 77), (8190, 0), (3, 5000), (1234, 4321)]
EVEN_RUNS = COLOR_RUNS[:4]
# Edge-bucket hash ((A_U*u + A_V*v + B) mod p) mod C.
BUCKET_A_U, BUCKET_A_V, BUCKET_B = 31, 57, 11

# Stream: open interval of counted items, sketch rows (a, b, ga, gb) and
# width, top-k size, stop threshold.
LEFT, RIGHT = 10, 100
SKETCH_ROWS = [(17, 23, 101, 7), (4001, 77, 3333, 1000), (8190, 0, 5, 8000)]
SKETCH_WIDTH = 64
# The same with the large prime.
LARGE_RUN = (1_220_703_125, 97)
LARGE_ROWS = [(48_271, 11, 1_583_458_089, 3), (69_621, 500, 784_588_716, 77),
              (630_360_016, 0, 950_706_376, 1_000_000)]
TOP_K = 10
THRESHOLD = 4500
# Micro-batches of the registered stream queries.
STREAM_STEPS = 5
# Parameter table: seed and number of runs.
RUN_SEED, NUM_RUNS = 42, 6
