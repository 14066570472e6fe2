"""Pages in the shapes that the portal's have."""

GRID = """<div><table id="ctl00_gdvPermitList" pagecount="3"><tr><td class="aca_gridview_caption">Showing 1-2 of 100+</td></tr>
<tr class="ACA_TabRow_Odd"><td><input id="RecordId" value="R1"><a href="/CapDetail.aspx?capID1=A&capID2=B&capID3=C"><span id="x_lblPermitNumber1">B26-1</span></a>
<span id="x_lblUpdatedTime">09/04/2026</span><span id="x_lblType">Roof&nbsp;&amp; gutter</span><span id="x_lblStatus">In Review</span></td></tr>
<tr class="ACA_TabRow_Even"><td><span id="y_lblPermitNumber">B26-2</span></td></tr><tr class="ACA_TabRow_Odd"><td></td></tr>
<tr><td class="aca_pagination_td"><span class="SelectedPageButton">1</span><a href="javascript:__doPostBack(&#39;ctl$2&#39;,&#39;&#39;)">2</a><a href="javascript:__doPostBack('n','')">Next &gt;</a></td></tr></table></div>"""

DETAIL = """<span id="ctl00_PlaceHolderMain_lblPermitNumber">B26-1</span><span id="ctl00_PlaceHolderMain_lblPermitType">Roof</span><span id="ctl00_PlaceHolderMain_lblRecordStatus">Issued</span>
<table><tr><td class="td_parent_left"><h1><span>Licensed Professional:</span></h1><table class="table_child"><tr><td>x</td><td>JANE DOE jane@x.com<br>ABC ROOFING LLC<br>12 MAIN ST<br>SUITE 5<br>KISSIMMEE, FL, 34741
<table><tr><td>Home Phone:</td><td><div>4075550100</div></td></tr></table><br>ROOFING CCC1330001</td></tr></table></td></tr>
<tr><td class="td_parent_left"><h1><span>Project Description:</span></h1><table class="table_child"><tr><td>re-roof<br>shingle</td></tr></table></td></tr></table>
<div><div class="MoreDetail_ItemCol1"><span>Job Value:</span></div><div class="MoreDetail_ItemCol2">$22,599.00</div><div class="MoreDetail_ItemCol1"><span>Parcel Number:</span><div>252628610005220080</div></div>
<div class="MoreDetail_ItemCol1"><h2>Application Date</h2></div><div class="MoreDetail_ItemCol2">9/4/2026</div></div>"""
