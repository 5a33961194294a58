"""Schemas of the run and status ledgers.

Names and types are fixed values, so that ledgers written before can be read and continued.
"""

from __future__ import annotations

from pyspark.sql import types as T

MIGRATION_RUNS = """
run_id string, dag_run_id string, excel_file_path string, started_at timestamp, completed_at timestamp,
status string, total_tables int, successful_tables int, failed_tables int, config_json string
"""

MIGRATION_TABLE_STATUS = """
run_id string, source_database string, source_table string, dest_database string, dest_bucket string,
dest_location string, source_location string, file_format string, partition_count int, is_partitioned boolean,
schema_json string, partitions_json string, partition_columns string, table_type string,
source_row_count bigint, source_total_size_bytes bigint, source_file_count bigint,
s3_total_size_bytes_before bigint, s3_file_count_before bigint, s3_total_size_bytes_after bigint,
s3_file_count_after bigint, s3_bytes_transferred bigint, s3_files_transferred bigint,
file_size_match boolean, file_count_match boolean, partition_filter string, filtered_partition_count int,
full_table_row_count bigint, full_table_partition_count int,
discovery_status string, discovery_completed_at timestamp, discovery_duration_seconds double,
distcp_status string, distcp_started_at timestamp, distcp_completed_at timestamp, distcp_duration_seconds double,
distcp_is_incremental boolean, distcp_bytes_copied bigint, distcp_files_copied bigint,
table_create_status string, table_create_completed_at timestamp, table_create_duration_seconds double,
table_already_existed boolean, validation_status string, validation_completed_at timestamp,
validation_duration_seconds double, dest_hive_row_count bigint, source_partition_count int,
unregistered_partitions boolean, dest_partition_count int, row_count_match boolean,
partition_count_match boolean, schema_match boolean, schema_differences string, overall_status string,
error_message string, updated_at timestamp
"""

ICEBERG_MIGRATION_RUNS = """
run_id string, dag_run_id string, excel_file_path string, migration_type string, started_at timestamp,
completed_at timestamp, status string, total_tables int, successful_tables int, failed_tables int, config_json string
"""

ICEBERG_MIGRATION_TABLE_STATUS = """
run_id string, dag_run_id string, source_database string, source_table string, migration_type string,
destination_database string, destination_table string, table_location string, started_at timestamp,
completed_at timestamp, migration_duration_seconds double, status string, source_hive_row_count bigint,
destination_iceberg_row_count bigint, row_count_match boolean, source_hive_partition_count int,
dest_iceberg_partition_count int, partition_count_match boolean, schema_match boolean, schema_differences string,
validation_status string, validation_completed_at timestamp, validation_duration_seconds double,
error_message string, updated_at timestamp
"""

DATA_COPY_RUNS = """
run_id string, excel_file_path string, started_at timestamp, completed_at timestamp, status string,
total_folders int, successful_folders int, failed_folders int, error_message string, created_at timestamp
"""

DATA_COPY_STATUS = """
run_id string, source_path string, dest_bucket string, dest_path string, status string, started_at timestamp,
completed_at timestamp, source_file_count bigint, source_size_bytes bigint, dest_file_count bigint,
dest_size_bytes bigint, files_copied bigint, bytes_copied bigint, is_incremental boolean,
file_count_match boolean, size_match boolean, error_message string, updated_at timestamp
"""

S3_MIGRATION_RUNS = """
run_id string, dag_run_id string, excel_file_path string, started_at timestamp, completed_at timestamp,
status string, total_tables int, successful_tables int, failed_tables int, missing_tables int, config_json string
"""

S3_MIGRATION_TABLE_STATUS = """
run_id string, source_database string, source_table string, dest_database string, dest_bucket string,
source_s3_location string, dest_s3_location string, file_format string, is_partitioned boolean,
partition_columns string, partition_count int, schema_json string, partitions_json string, table_type string,
source_row_count bigint, source_file_count bigint, source_total_size_bytes bigint,
data_presence_status string, data_presence_checked_at timestamp, data_presence_file_count bigint,
data_presence_size_bytes bigint, discovery_status string, discovery_completed_at timestamp,
discovery_duration_seconds double, table_create_status string, table_create_completed_at timestamp,
table_create_duration_seconds double, table_already_existed boolean, validation_status string,
validation_completed_at timestamp, validation_duration_seconds double, dest_hive_row_count bigint,
dest_partition_count int, source_partition_count int, row_count_match boolean, partition_count_match boolean,
schema_match boolean, schema_differences string, overall_status string, error_message string, updated_at timestamp
"""

POLICY_RUNS = """
run_id string, dag_run_id string, excel_file_path string, started_at timestamp, completed_at timestamp,
status string, total_objects int, successful_objects int, failed_objects int, total_policies_parsed int,
total_role_mappings_parsed int, groups_created int, groups_existing int, policies_created int,
policies_updated int, policies_failed int, roles_created int, roles_existing int, mappings_created int,
mappings_existing int, failed_operations int, error_message string, created_at timestamp, updated_at timestamp
"""

POLICY_OBJECT_STATUS = """
run_id string, object_type string, object_name string, policy_id string, policy_name string, status string,
error_message string, attempt int, started_at timestamp, completed_at timestamp, created_at timestamp,
updated_at timestamp
"""

POLICY_STATUS = """
run_id string, policy_id string, policy_name string, users array<string>, groups array<string>,
permissions array<string>, rowfilter string, status string, error_message string, created_at timestamp,
updated_at timestamp, attributes string
"""

POLICY_SKIPPED_ROWS = """
run_id string, row_index int, role string, database string, url string, reason string, created_at timestamp
"""

LEDGERS = {
    "migration_runs": MIGRATION_RUNS,
    "migration_table_status": MIGRATION_TABLE_STATUS,
    "iceberg_migration_runs": ICEBERG_MIGRATION_RUNS,
    "iceberg_migration_table_status": ICEBERG_MIGRATION_TABLE_STATUS,
    "data_copy_runs": DATA_COPY_RUNS,
    "data_copy_status": DATA_COPY_STATUS,
    "s3_migration_runs": S3_MIGRATION_RUNS,
    "s3_migration_table_status": S3_MIGRATION_TABLE_STATUS,
    "tracking_ranger_policy_runs": POLICY_RUNS,
    "tracking_ranger_policy_object_status": POLICY_OBJECT_STATUS,
    "tracking_ranger_policy_status": POLICY_STATUS,
    "tracking_ranger_policy_skipped_rows": POLICY_SKIPPED_ROWS,
}


def ledger_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(LEDGERS[name])
