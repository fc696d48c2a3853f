"""Parameters of the registered queries (shared by the Spark and SQL forms)."""

# --- fixed values: equal to the reference's ---------------------------------
# sampling seed of the maximum-distance program; K = 4 partitions of the
# published class example; k = 100, L = 16 of its published cluster run
SAMPLE_SEED = 1231829
K_PARTS = 4
BASELINE_K = 100
BASELINE_L = 16

# --- own choices -------------------------------------------------------------
SALT_K = 8           # salts for the two-round word count
SAMPLE_K = 10        # sample size for X1 / D2
CENTERS_K = 6        # k for farthest-first / k-center
DIVERSITY_K = 6      # k for the diversity queries on embeddings
DIVERSITY_L = 4      # L parts for the coreset round
GREEDY_K = 7         # k for greedy pairs on the whole point table (odd: exercises the extra pick)
ORDERS_DIV_K = 20    # a smaller diversity run on orders that SQL can check
ORDERS_DIV_L = 8
TREE_L = 32          # parts of the coreset tree; 4 are merged per round until TREE_ROWS points remain
TREE_FAN_IN = 4
TREE_ROWS = 30
MANY_CENTERS = 1000  # centers (a seeded sample) of the nearest-center query with many centers
