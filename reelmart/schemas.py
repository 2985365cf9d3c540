"""Declared schemas: landed payloads, control records, silver and gold tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

# Field names and types of the landed JSON payloads.
USER_AGENT = "struct<browser:string,browser_version:string,mobile:boolean,platform:string>"

PAYLOADS = {
    "media": """
        archived boolean,
        assets array<struct<content_type:string,file_size:bigint,height:bigint,type:string,url:string,width:bigint>>,
        created string, description string, duration double,
        folder struct<hashed_id:string,id:bigint,name:string>,
        hashed_id string, id bigint, name string, progress double, protected boolean,
        section string, status string,
        thumbnail struct<height:bigint,url:string,width:bigint>,
        type string, updated string""",
    "media_stats": """
        engagement double, hours_watched double, load_count bigint, play_count bigint,
        play_rate double, visitors bigint""",
    "media_daily_stats": "date string, hours_watched double, load_count bigint, play_count bigint",
    "engagement": "engagement double, engagement_data array<bigint>, rewatch_data array<bigint>",
    "events": f"""
        city string, conversion_type string, country string, email string, embed_url string,
        event_key string, iframe_heatmap_url string, ip string, lat double, lon double,
        media_id string, media_name string, media_url string, org string,
        percent_viewed double, received_at string, region string,
        user_agent_details {USER_AGENT}, visitor_key string""",
    "visitors": f"""
        created_at string, last_active_at string, last_event_key string,
        load_count bigint, play_count bigint, user_agent_details {USER_AGENT},
        visitor_identity struct<email:string,name:string,org:struct<name:string,title:string>>,
        visitor_key string""",
}

WATERMARK_MAP = "map<string,struct<last_successful_end_date:string>>"

# Audit records of all stages and the control record.
AUDIT = f"""
    run_id string, pipeline_stage string, status string, start_ts string, end_ts string,
    media_count bigint, visitor_objects_written bigint, bronze_object_count bigint,
    endpoint_audit array<struct<media_id:string,endpoint:string,start_date:string,end_date:string,
        pages_fetched:bigint,records_fetched:bigint,bronze_object_count:bigint,status:string>>,
    candidate_watermark struct<events:{WATERMARK_MAP},run_id:string,created_at:string>,
    successful_bronze_runs_processed bigint, bronze_run_ids array<string>,
    gold_run_id string, audit_keys array<string>, committed_media bigint,
    row_counts map<string,bigint>, note string, error_type string, error_message string"""

CONTROL = f"events {WATERMARK_MAP}, last_pipeline_run_id string, updated_at string"


@dataclass(frozen=True)
class Contract:
    """What a published table promises; the checks of J1-J4, J7 and J8 follow it."""

    columns: str
    key: tuple[str, ...]
    grain: str
    not_blank: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    pii: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    @property
    def names(self) -> list[str]:
        return self.schema.names


# Column names, types, keys, personal-data columns and partitions.
SILVER = {
    "media": Contract(
        """media_id string, numeric_id bigint, hashed_id string, title string, description string,
        duration_seconds double, media_type string, status string, archived boolean, progress double,
        created_at timestamp, updated_at timestamp, folder_id bigint, folder_hashed_id string,
        folder_name string, thumbnail_url string, thumbnail_width bigint, thumbnail_height bigint,
        asset_count int, assets_json string, ingestion_date date, run_id string, ingested_at timestamp""",
        key=("media_id",), grain="latest row per media", not_blank=("media_id",),
    ),
    "media_stats": Contract(
        """media_id string, engagement double, hours_watched double, load_count bigint,
        play_count bigint, play_rate double, visitors bigint, snapshot_at timestamp,
        ingestion_date date, run_id string""",
        key=("media_id", "run_id"), grain="one cumulative snapshot per media and successful run",
        not_blank=("media_id",), partitions=("ingestion_date",),
    ),
    "media_daily_stats": Contract(
        """media_id string, stat_date date, hours_watched double, load_count bigint,
        play_count bigint, ingested_at timestamp, run_id string, stat_year int, stat_month int""",
        key=("media_id", "stat_date"), grain="latest observed row per media and date",
        not_blank=("media_id",), not_null=("stat_date",), partitions=("stat_year", "stat_month"),
    ),
    "engagement": Contract(
        """media_id string, engagement double, engagement_data array<bigint>,
        rewatch_data array<bigint>, snapshot_at timestamp, ingestion_date date, run_id string""",
        key=("media_id", "run_id"), grain="one curve snapshot per media and successful run",
        not_blank=("media_id",), partitions=("ingestion_date",),
    ),
    "events": Contract(
        """event_key string, media_id string, visitor_key string, received_at timestamp,
        percent_viewed double, country string, region string, city string, lat double, lon double,
        ip_address string, email string, org string, embed_url string, media_name string,
        media_url string, conversion_type string, browser string, browser_version string,
        is_mobile boolean, platform string, ingested_at timestamp, run_id string, event_date date""",
        key=("event_key",), grain="latest row per event", not_blank=("event_key", "media_id"),
        pii=("ip_address", "email"), partitions=("event_date",),
    ),
    "visitors": Contract(
        """visitor_key string, created_at timestamp, last_active_at timestamp, last_event_key string,
        load_count bigint, play_count bigint, email string, visitor_name string,
        organization_name string, organization_title string, browser string,
        browser_version string, is_mobile boolean, platform string, ingested_at timestamp, run_id string""",
        key=("visitor_key",), grain="latest row per visitor", not_blank=("visitor_key",),
        pii=("email", "visitor_name"),
    ),
}

# Fixed names: where a silver column comes from in a landed row, if not from a field of its
# own name. What is computed stands in plans.silver.
AGENT_SOURCES = {
    "browser": "user_agent_details.browser",
    "browser_version": "user_agent_details.browser_version",
    "is_mobile": "user_agent_details.mobile",
    "platform": "user_agent_details.platform",
}

SILVER_SOURCES = {
    "media": {
        "media_id": "media_id_from_path", "numeric_id": "id", "title": "name", "duration_seconds": "duration",
        "media_type": "type", "folder_id": "folder.id", "folder_hashed_id": "folder.hashed_id",
        "folder_name": "folder.name", "thumbnail_url": "thumbnail.url", "thumbnail_width": "thumbnail.width",
        "thumbnail_height": "thumbnail.height",
    },
    "media_stats": {"media_id": "media_id_from_path", "snapshot_at": "ingested_at"},
    "media_daily_stats": {"media_id": "media_id_from_path"},
    "engagement": {"media_id": "media_id_from_path", "snapshot_at": "ingested_at"},
    "events": {"ip_address": "ip", **AGENT_SOURCES},
    "visitors": {
        "email": "visitor_identity.email", "visitor_name": "visitor_identity.name",
        "organization_name": "visitor_identity.org.name", "organization_title": "visitor_identity.org.title",
        **AGENT_SOURCES,
    },
}

GOLD = {
    "dim_media": Contract(
        """media_id string, numeric_id bigint, hashed_id string, title string, description string,
        duration_seconds double, media_type string, status string, archived boolean,
        created_at timestamp, updated_at timestamp, folder_name string, thumbnail_url string""",
        key=("media_id",), grain="one row per media", not_blank=("media_id",),
    ),
    "dim_visitor": Contract(
        """visitor_key string, created_at timestamp, last_active_at timestamp, load_count bigint,
        play_count bigint, email string, visitor_name string, organization_name string,
        organization_title string, browser string, browser_version string, is_mobile boolean,
        platform string, last_ip_address string, last_country string, last_region string,
        last_city string, last_event_at timestamp""",
        key=("visitor_key",), grain="one row per visitor", not_blank=("visitor_key",),
        pii=("email", "visitor_name", "last_ip_address"),
    ),
    "dim_date": Contract(
        """date_key int, full_date date, year int, quarter int, month int, day int,
        day_name string, week_of_year int""",
        key=("date_key",), grain="one row per observed date",
    ),
    "fact_engagement_event": Contract(
        """event_key string, media_id string, visitor_key string, date_key int, event_date date,
        received_at timestamp, percent_viewed double, country string, region string, city string,
        ip_address string, conversion_type string, browser string, browser_version string,
        is_mobile boolean, platform string""",
        key=("event_key",), grain="one row per event", not_blank=("event_key", "media_id"),
        pii=("ip_address",), partitions=("event_date",),
        foreign_keys=(("media_id", "dim_media", "media_id"),),
    ),
    "fact_media_engagement": Contract(
        """media_id string, stat_date date, load_count bigint, play_count bigint,
        total_watch_time_hours double, event_count bigint, unique_visitors bigint,
        watched_percent double, play_rate double, total_watch_time_seconds double,
        date_key int, year int, month int""",
        key=("media_id", "stat_date"), grain="one row per media and date",
        not_blank=("media_id",), not_null=("stat_date",), partitions=("year", "month"),
        foreign_keys=(("media_id", "dim_media", "media_id"),),
    ),
}
