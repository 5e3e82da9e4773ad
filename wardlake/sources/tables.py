"""Clinical source tables: schemas, lazy table sets, Parquet and JDBC readers."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from wardlake.operators import skew

# Column names and types of the ten source tables.
CLINICAL_SCHEMAS = {
    "patients": "patient_id bigint, first_name string, last_name string, date_of_birth date, gender string, mrn string",
    "specialties": "specialty_id bigint, specialty_name string, specialty_code string",
    "departments": "department_id bigint, department_name string, floor int, capacity int",
    "providers": "provider_id bigint, first_name string, last_name string, credential string, "
    "specialty_id bigint, department_id bigint",
    "encounters": "encounter_id bigint, patient_id bigint, provider_id bigint, encounter_type string, "
    "encounter_date timestamp_ntz, discharge_date timestamp_ntz, department_id bigint",
    "diagnoses": "diagnosis_id bigint, icd10_code string, icd10_description string",
    "encounter_diagnoses": "encounter_diagnosis_id bigint, encounter_id bigint, diagnosis_id bigint, diagnosis_sequence int",
    "procedures": "procedure_id bigint, cpt_code string, cpt_description string",
    "encounter_procedures": "encounter_procedure_id bigint, encounter_id bigint, procedure_id bigint, procedure_date date",
    "billing": "billing_id bigint, encounter_id bigint, claim_amount decimal(12,2), allowed_amount decimal(12,2), "
    "claim_date date, claim_status string",
}


class TableSet(Mapping):
    """Named tables, each built on first use so that unused ones cost nothing.

    The keys with very many rows are looked up once per table and kept; they only steer how work is split. ``hot_from``
    names the stored column that a derived column copies: (table, column) -> (table set, table, column).
    """

    def __init__(self, spark: SparkSession, makers: Mapping[str, Callable[[], DataFrame]], hot_from: Mapping | None = None):
        self.spark = spark
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}
        self._hot_from = dict(hot_from or {})
        self._hot: dict[tuple[str, str], list] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self):
        return len(self._makers)

    def hot_keys(self, name: str, column: str) -> list:
        """Values of the column held by so many rows that their group must be split."""
        place = (name, column)
        if place not in self._hot:
            if place in self._hot_from:
                tables, table, stored_column = self._hot_from[place]
                self._hot[place] = tables.hot_keys(table, stored_column)
            else:
                self._hot[place] = skew.hot_keys(self[name], column)
        return self._hot[place]

    def register_views(self) -> None:
        """Publish every table as a temporary view."""
        for name in self:
            self[name].createOrReplaceTempView(name)

    def replacing(self, **tables: DataFrame) -> "TableSet":
        """Copy with some tables exchanged; what is known of the hot keys of the others stays."""
        makers = dict(self._makers)
        makers.update({name: (lambda df=df: df) for name, df in tables.items()})
        copy = TableSet(self.spark, makers, {place: where for place, where in self._hot_from.items() if place[0] not in tables})
        copy._hot = {place: keys for place, keys in self._hot.items() if place[0] not in tables}
        return copy


def _parquet_makers(spark, folder, schemas):
    return {
        name: (lambda n=name, s=schema: spark.read.schema(s).parquet(f"{folder.rstrip('/')}/{n}"))
        for name, schema in schemas.items()
    }


def open_clinical_parquet(spark: SparkSession, folder: str) -> TableSet:
    """Clinical tables stored as Parquet folders, read with the declared schemas."""
    return TableSet(spark, _parquet_makers(spark, folder, CLINICAL_SCHEMAS))


def open_clinical_jdbc(
    spark: SparkSession,
    url: str,
    partitions: Mapping[str, tuple[str, int, int, int]] | None = None,
    **options: str,
) -> TableSet:
    """Clinical tables of a live database over JDBC.

    ``partitions`` maps a table to (column, lower bound, upper bound, number of partitions), so that a large table is
    read by many tasks at once. Filters and column lists are pushed into the remote query by Spark.
    """
    partitions = dict(partitions or {})

    def maker(name: str) -> Callable[[], DataFrame]:
        def read() -> DataFrame:
            reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
            # Times of the source carry no zone.
            reader = reader.option("customSchema", CLINICAL_SCHEMAS[name]).option("preferTimestampNTZ", "true").options(**options)
            if name in partitions:
                column, lower, upper, count = partitions[name]
                reader = (
                    reader.option("partitionColumn", column)
                    .option("lowerBound", lower)
                    .option("upperBound", upper)
                    .option("numPartitions", count)
                )
            return reader.load()

        return read

    return TableSet(spark, {name: maker(name) for name in CLINICAL_SCHEMAS})


def store_tables(tables: Mapping[str, DataFrame], folder: str, files: int | None = None) -> None:
    """Write every table of the set as a Parquet folder, optionally spread evenly over a number of files."""
    for name in tables:
        table = tables[name].repartition(files) if files else tables[name]
        table.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")
