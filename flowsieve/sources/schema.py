"""Column contract of the payment table."""

from pyspark.sql import types as T

# Names and order every reader and operator agrees on.
RAW_CSV = T.StructType(
    [
        T.StructField("ts_text", T.StringType()),
        T.StructField("from_bank", T.LongType()),
        T.StructField("from_account", T.StringType()),
        T.StructField("to_bank", T.LongType()),
        T.StructField("to_account", T.StringType()),
        T.StructField("amount_received", T.DoubleType()),
        T.StructField("receiving_currency", T.StringType()),
        T.StructField("amount_paid", T.DoubleType()),
        T.StructField("payment_currency", T.StringType()),
        T.StructField("payment_format", T.StringType()),
        T.StructField("is_laundering", T.IntegerType()),
    ]
)
CSV_HEADER = [
    "Timestamp", "From Bank", "Account", "To Bank", "Account", "Amount Received", "Receiving Currency",
    "Amount Paid", "Payment Currency", "Payment Format", "Is Laundering",
]

BASE_NUMERIC = [
    "amount_paid", "amount_received", "log_amount_paid", "log_amount_received", "amount_diff",
    "hour", "weekday", "is_weekend", "same_currency", "same_bank",
]
CATEGORICAL = ["payment_currency", "receiving_currency", "payment_format"]
GRAPH_NUMERIC = [
    "sender_out_degree", "sender_unique_receivers", "sender_total_sent", "sender_mean_sent",
    "receiver_in_degree", "receiver_unique_senders", "receiver_total_received", "receiver_mean_received",
    "sent_received_ratio", "sender_pagerank", "receiver_pagerank",
    "sample_sender_out_degree", "sample_receiver_in_degree",
]
HISTORY_NUMERIC = [
    "hist_sender_sent_count", "hist_sender_received_count",
    "hist_receiver_received_count", "hist_receiver_sent_count",
    "hist_sender_unique_receivers", "hist_receiver_unique_senders",
    "hist_pair_count", "hist_reverse_pair_count",
    "hist_sender_total_sent", "hist_receiver_total_received",
    "hist_sender_mean_sent", "hist_receiver_mean_received",
    "hist_sender_out_in_ratio", "hist_receiver_in_out_ratio",
    "hist_sender_hours_since_sent", "hist_receiver_hours_since_received",
    "hist_sender_sent_24h", "hist_receiver_received_24h",
    "hist_sender_sent_7d", "hist_receiver_received_7d",
    "hist_amount_vs_sender_mean", "hist_amount_vs_receiver_mean",
    "hist_sender_seen", "hist_receiver_seen", "hist_pair_seen", "hist_reverse_pair_seen",
]
ACCOUNT_NUMERIC = [
    "sent_count", "received_count", "total_sent", "total_received", "mean_sent", "mean_received",
    "unique_receivers", "unique_senders", "in_out_count_ratio", "in_out_amount_ratio", "net_amount_flow",
    "fan_out_score", "fan_in_score", "scatter_gather_score", "max_sent_per_hour", "max_received_per_hour",
]
ACCOUNT_LOGGED = ["total_sent", "total_received", "mean_sent", "mean_received", "net_amount_flow"]
