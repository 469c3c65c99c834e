"""Row types of the data the jobs read and write. Timestamps are UTC instants."""

from pyspark.sql.types import (ArrayType, BooleanType, DataType, DateType, DoubleType, FloatType,
                               IntegerType, LongType, MapType, StringType, StructField,
                               StructType, TimestampType)

S, I, L, D, FL = StringType(), IntegerType(), LongType(), DoubleType(), FloatType()
B, DAY, TS, TEXTS = BooleanType(), DateType(), TimestampType(), MapType(S, S)


def _row(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# JSON body of a client message.
MESSAGE = _row(
    client_id=S, client_name=S, timestamp=TS, event_type=S, data=TEXTS, amount=D, status=S,
    metadata=TEXTS,
)

# A second, smaller kind of body: an id, free data and a time.
EVENT_BODY = _row(id=S, data=S, timestamp=TS)

# What a broker delivers, with key and value already text.
RAW_MESSAGE = _row(
    kafka_key=S, kafka_value=S, kafka_topic=S, kafka_partition=I, kafka_offset=L,
    kafka_timestamp=TS,
)

PIPELINE_ERROR = _row(client_id=S, table_name=S, error_message=S, error_timestamp=TS)

SCHOOLS = _row(
    school_id=S, name=S, district=S, state=S, school_type=S, grade_range=S,
    student_capacity=I,
)
EDUCATORS = _row(
    educator_id=S, first_name=S, last_name=S, email=S, role=S, certification=S, school_id=S,
    hire_date=DAY, status=S,
)
CLASSROOMS = _row(
    classroom_id=S, name=S, grade_level=S, school_id=S, educator_id=S, capacity=I,
    program_type=S,
)
STUDENTS = _row(
    student_id=S, first_name=S, last_name=S, date_of_birth=DAY, grade_level=S, school_id=S,
    classroom_id=S, enrollment_date=DAY, status=S,
)
LEARNING_OBJECTIVES = _row(
    objective_id=S, subject=S, domain=S, description=S, grade_level=S, standard_code=S,
)
ASSESSMENTS = _row(
    assessment_id=S, student_id=S, educator_id=S, subject=S, domain=S, score=D,
    assessment_date=DAY, assessment_period=S, learning_objective_id=S, notes=S,
)

ORDERS = _row(
    order_id=S, customer_name=S, email=S, state=S, order_amount=D, category=S, order_ts=TS,
    status=S,
)
RUN_METRICS = _row(
    run_id=S, job_id=S, run_ts=TS, bronze_rows=L, silver_rows=L, gold_rows=L,
    total_duration_sec=FL, status=S,
)

ATTACHMENT_HITS = _row(
    attachment_id=S, attachment_unique_id=S, email_unique_id=S, message_id=S, user_email=S,
    drive_item_unique_id=S, attachment_name=S, attachment_type=S, reference_type=S,
    share_type=S, file_extension=S, content_type=S, mime_type=S, size=L, size_display=S,
    is_inline=B, last_modified_date_time=TS, drive_id=S, site_id=S,
    sensitivity_label_display_name=S, sensitivity_label_id=S,
    sensitivity_label_protection_enabled=B, rls_org_key=S, cloud_storage_organization_id=S,
    sit_id=S, sit_name=S, hit_id=S, hit_rank=I, sit_summary=S, classification_type=S,
    classification_last_scan=TS,
)
EMAIL_SUMMARY = _row(
    unique_email_id=S, email_id=S, cloud_storage_organization_id=S, rls_org_key=S,
    user_email=S, created_date_time=TS, created_date=DAY, last_modified_date_time=TS,
    last_modified_date=DAY, received_date_time=TS, received_date=DAY, sent_date_time=TS,
    sent_date=DAY, has_attachments=B, internet_message_id=S, subject=S, importance=S,
    parent_folder_id=S, conversation_id=S, is_read=B, is_draft=B, web_link=S,
    inference_classification=S, flag_status=S, email_sensitivity_label_id=S,
    email_sensitivity_label_name=S, email_category=S, email_category_label=S,
    email_odata_type=S, sender_name=S, sender_address=S, from_name=S, from_address=S,
    sender_address_domain=S, sender_address_domain_is_external=B,
    sender_address_domain_is_consumer=B, from_address_domain=S,
    from_address_domain_is_external=B, from_address_domain_is_consumer=B, recipient_count=L,
    to_count=L, cc_count=L, bcc_count=L, reply_to_count=L, external_recipient_count=L,
    has_external_recipient=B, has_consumer_recipient=B, attachment_count=L,
    attachment_size=L, attachment_size_display=S,
)

# The nested part of a refresh log row that the analysis reads.
REFRESH_DETAILS = _row(
    planning_information=_row(
        technique_information=ArrayType(_row(
            is_chosen=B, maintenance_type=S, cost=D,
            incrementalization_issues=ArrayType(_row(issue_type=S)))),
        source_table_information=ArrayType(_row(num_rows=L)),
    ),
    flow_definition=_row(output_dataset=S, explain_text=S, flow_type=S),
)
EVENT_LOG = _row(
    id=S, sequence=S,
    origin=_row(update_id=S, org_id=S, pipeline_id=S, pipeline_name=S),
    timestamp=TS, message=S, level=S, event_type=S, maturity_level=S, pipeline_id=S,
    pipeline_name=S, error=S, details=S,
)

AUDIT = _row(
    service_name=S, action_name=S, event_time=TS, request_params=_row(dashboard_id=S),
    user_identity=_row(email=S), identity_metadata=_row(run_by=S, run_as=S),
)

# One fetched document: the symbol and a map from date to that day's named figures.
STOCK_PAYLOAD = StructType([StructField("Meta Data", TEXTS),
                            StructField("Time Series (Daily)", MapType(S, TEXTS))])

MASKED_EMAIL = _row(
    email_id=L, customer_id=I, subject=S, content=S, sentiment=D, received_date=DAY,
    requested_amount=D, processed=S,
)
NAME_ROW = _row(id=L, name=S)
