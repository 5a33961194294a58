"""Rewrite tables for moving DAG files from Airflow 2 to 3.

Names, categories, severities and replacement texts are fixed values. Import rules that only move
a name are built from the old and new module.
"""

from __future__ import annotations

from typing import NamedTuple


class ImportRule(NamedTuple):
    """``from module import name``; ``name`` None takes any names and carries them over.

    ``target`` is the new module, or a whole replacement line when it starts with ``#``.
    """

    module: str
    name: str | None
    target: str
    new_name: str | None
    category: str
    severity: str


SDK, STANDARD, ASSETS = "SDK Migration", "Standard Provider", "Assets Rename"
NO_DB = "# REMOVED: Direct DB access removed in Airflow 3; use REST API via apache-airflow-client"
SQL_MODULE, SQL_OPERATOR = "airflow.providers.common.sql.operators.sql", "SQLExecuteQueryOperator"
STD_OPERATORS = "airflow.providers.standard.operators."
STD_SENSORS = "airflow.providers.standard.sensors."
STD_HOOKS = "airflow.providers.standard.hooks."


def _kept(module: str, name: str, target: str, category: str = SDK, severity: str = "DEPRECATED") -> ImportRule:
    return ImportRule(module, name, target, name, category, severity)


def _any(module: str, target: str, category: str = STANDARD) -> ImportRule:
    return ImportRule(module, None, target, None, category, "DEPRECATED")


def _new(module: str, name: str, target: str, new_name: str | None, category: str) -> ImportRule:
    return ImportRule(module, name, target, new_name, category, "BREAKING")


# Fixed values, in rule order: the first rule that fits a line decides.
IMPORT_RULES = [
    _any("airflow.decorators", "airflow.sdk", SDK),
    _kept("airflow", "DAG", "airflow.sdk"),
    _kept("airflow.models.dag", "DAG", "airflow.sdk"),
    _kept("airflow.models", "Variable", "airflow.sdk"),
    _kept("airflow.models.param", "Param", "airflow.sdk.definitions.param"),
    _kept("airflow.models.param", "ParamsDict", "airflow.sdk.definitions.param"),
    _kept("airflow.models", "BaseOperator", "airflow.sdk"),
    _kept("airflow.models.baseoperator", "BaseOperator", "airflow.sdk"),
    _kept("airflow.models.baseoperator", "chain", "airflow.sdk"),
    _kept("airflow.sensors.base", "BaseSensorOperator", "airflow.sdk.bases.sensor"),
    _kept("airflow.sensors.base_sensor_operator", "BaseSensorOperator", "airflow.sdk.bases.sensor", SDK, "BREAKING"),
    _kept("airflow.sensors.base", "PokeReturnValue", "airflow.sdk.bases.sensor"),
    _kept("airflow.hooks.base", "BaseHook", "airflow.sdk.bases.hook"),
    _kept("airflow.utils.task_group", "TaskGroup", "airflow.sdk"),
    _kept("airflow.decorators", "task_group", "airflow.sdk"),
    _kept("airflow.notifications.basenotifier", "BaseNotifier", "airflow.sdk"),
    _kept("airflow.models.baseoperatorlink", "BaseOperatorLink", "airflow.sdk"),
    _kept("airflow.models.connection", "Connection", "airflow.sdk"),
    _kept("airflow.utils.context", "Context", "airflow.sdk"),
    _kept("airflow.operators.python", "get_current_context", "airflow.sdk"),
    _kept("airflow.io.path", "ObjectStoragePath", "airflow.sdk"),
    _new("airflow.models.taskmixin", "TaskMixin", "airflow.models.taskmixin", "DependencyMixin", SDK),
    _new("airflow.models", "ImportError", "airflow.models.errors", "ParseImportError", SDK),
    _new("airflow.exceptions", "FailStopDagInvalidTriggerRule", "airflow.exceptions", "FailFastDagInvalidTriggerRule", SDK),
    _new("airflow.datasets", "Dataset", "airflow.sdk", "Asset", ASSETS),
    _new("airflow.datasets", "DatasetAlias", "airflow.sdk", "AssetAlias", ASSETS),
    _new("airflow.datasets", "DatasetAll", "airflow.sdk", "AssetAll", ASSETS),
    _new("airflow.datasets", "DatasetAny", "airflow.sdk", "AssetAny", ASSETS),
    _new("airflow.datasets.metadata", "Metadata", "airflow.sdk", "Metadata", ASSETS),
    _new("airflow.datasets", "DatasetEvent", "airflow.sdk", "AssetEvent", ASSETS),
    _new("airflow.datasets.manager", "DatasetManager", "airflow.assets.manager", "AssetManager", ASSETS),
    _kept("airflow.operators.bash", "BashOperator", STD_OPERATORS + "bash", STANDARD),
    _kept("airflow.operators.python", "PythonOperator", STD_OPERATORS + "python", STANDARD),
    _any("airflow.operators.python", STD_OPERATORS + "python"),
    _kept("airflow.operators.empty", "EmptyOperator", STD_OPERATORS + "empty", STANDARD),
    _new("airflow.operators.dummy", "DummyOperator", STD_OPERATORS + "empty", "EmptyOperator", STANDARD),
    _kept("airflow.operators.trigger_dagrun", "TriggerDagRunOperator", STD_OPERATORS + "trigger_dagrun", STANDARD),
    _any("airflow.operators.datetime", STD_OPERATORS + "datetime"),
    _kept("airflow.operators.latest_only", "LatestOnlyOperator", STD_OPERATORS + "latest_only", STANDARD),
    _any("airflow.operators.weekday", STD_OPERATORS + "weekday"),
    _new("airflow.operators.subdag", "SubDagOperator", "# REMOVED: SubDagOperator - refactor to TaskGroup", None, "Removed Feature"),
    _any("airflow.sensors.python", STD_SENSORS + "python"),
    _any("airflow.sensors.bash", STD_SENSORS + "bash"),
    _any("airflow.sensors.date_time", STD_SENSORS + "date_time"),
    _any("airflow.sensors.time_delta", STD_SENSORS + "time_delta"),
    _any("airflow.sensors.external_task", STD_SENSORS + "external_task"),
    _any("airflow.sensors.filesystem", STD_SENSORS + "filesystem"),
    _any("airflow.sensors.weekday", STD_SENSORS + "weekday"),
    _any("airflow.sensors.time_sensor", STD_SENSORS + "time"),
    _kept("airflow.hooks.filesystem", "FSHook", STD_HOOKS + "filesystem", STANDARD),
    _kept("airflow.hooks.subprocess", "SubprocessHook", STD_HOOKS + "subprocess", STANDARD),
    _kept("airflow.providers.cncf.kubernetes.operators.kubernetes_pod", "KubernetesPodOperator", "airflow.providers.cncf.kubernetes.operators.pod", "K8s Operator", "BREAKING"),
    _new("airflow.providers.trino.operators.trino", "TrinoOperator", SQL_MODULE, SQL_OPERATOR, "SQL Operator"),
    _new("airflow.providers.postgres.operators.postgres", "PostgresOperator", SQL_MODULE, SQL_OPERATOR, "SQL Operator"),
    _new("airflow.providers.mysql.operators.mysql", "MySqlOperator", SQL_MODULE, SQL_OPERATOR, "SQL Operator"),
    _new("airflow.providers.microsoft.mssql.operators.mssql", "MsSqlOperator", SQL_MODULE, SQL_OPERATOR, "SQL Operator"),
    _new("airflow.providers.snowflake.operators.snowflake", "SnowflakeOperator", SQL_MODULE, SQL_OPERATOR, "SQL Operator"),
    _new("airflow.providers.apache.hive.operators.hive", "HiveOperator", SQL_MODULE, SQL_OPERATOR, "SQL Operator"),
    _new("airflow.utils.dates", "days_ago", "# REMOVED: days_ago - use pendulum.today('UTC').add(days=-N) instead", None, "Removed Utility"),
    _new("airflow.utils.dates", None, "# REMOVED: airflow.utils.dates module removed in Airflow 3", None, "Removed Utility"),
    _new("airflow.www.security", "AirflowSecurityManager", "airflow.providers.fab.auth_manager.security_manager.override", "FabAirflowSecurityManagerOverride", "Auth Manager"),
    _new("airflow.auth.managers.fab.fab_auth_manager", "FabAuthManager", "airflow.providers.fab.auth_manager.fab_auth_manager", "FabAuthManager", "Auth Manager"),
    _new("airflow.utils.db", "create_session", NO_DB, None, "Database Access"),
    _new("airflow.utils.session", "provide_session", NO_DB, None, "Database Access"),
    _kept("airflow.providers.apache.spark.operators.spark_submit", "SparkSubmitOperator", "airflow.providers.apache.spark.operators.spark_submit", "Spark Provider", "WARNING"),
]

# DAG parameters and their new names.
DAG_PARAMETERS = {
    "schedule_interval": "schedule",
    "timetable": "schedule",
    "task_concurrency": "max_active_tis_per_dag",
    "fail_stop": "fail_fast",
}

# Context keys; only the first has a successor.
CONTEXT_KEYS = {
    "execution_date": "logical_date",
    "tomorrow_ds": None,
    "tomorrow_ds_nodash": None,
    "yesterday_ds": None,
    "yesterday_ds_nodash": None,
    "prev_ds": None,
    "prev_ds_nodash": None,
    "prev_execution_date": None,
    "prev_execution_date_success": None,
    "next_execution_date": None,
    "next_ds": None,
    "next_ds_nodash": None,
}

# Trigger rules, operator classes, connection parameters, asset classes.
TRIGGER_RULES = {"NONE_FAILED_OR_SKIPPED": "NONE_FAILED_MIN_ONE_SUCCESS", "DUMMY": "ALWAYS"}
OPERATOR_CLASSES = {
    "DummyOperator": "EmptyOperator",
    "TrinoOperator": "SQLExecuteQueryOperator",
    "PostgresOperator": "SQLExecuteQueryOperator",
    "MySqlOperator": "SQLExecuteQueryOperator",
    "MsSqlOperator": "SQLExecuteQueryOperator",
    "SnowflakeOperator": "SQLExecuteQueryOperator",
    "HiveOperator": "SQLExecuteQueryOperator",
}
CONNECTION_PARAMETERS = {
    "trino_conn_id": "conn_id",
    "postgres_conn_id": "conn_id",
    "mysql_conn_id": "conn_id",
    "mssql_conn_id": "conn_id",
    "snowflake_conn_id": "conn_id",
    "hive_cli_conn_id": "conn_id",
    "bigquery_conn_id": "gcp_conn_id",
    "google_cloud_storage_conn_id": "gcp_conn_id",
    "datastore_conn_id": "gcp_conn_id",
    "s3_conn_id": "aws_conn_id",
}
ASSET_CLASSES = {
    "DatasetAlias": "AssetAlias",
    "DatasetAll": "AssetAll",
    "DatasetAny": "AssetAny",
    "DatasetEvent": "AssetEvent",
}
# Findings that need a person, with the marker line put in their place.
SLA_MARK = "# REMOVED: SLAs removed in Airflow 3; use custom monitoring or Deadline Alerts"
SLA_CALLBACK_MARK = "# REMOVED: sla_miss_callback removed in Airflow 3"
DB_ACCESS = [
    (r"\bSession\s*\(\s*\)", "Direct Session() instantiation blocked in Airflow 3 tasks"),
    (r"\bDagRun\.find\s*\(", "DagRun.find() blocked in tasks; use REST API client"),
    (r"\.get_previous_dagrun\s*\(", "get_previous_dagrun() removed from context DagRun"),
]
# Names a DAG corpus leaves out besides backups.
DAG_EXCLUDES = ("__pycache__", ".git", ".airflow2.bak")
